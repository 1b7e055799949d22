"""PII surrogates, in DataFrame functions only.

Entities are found by pattern. Each distinct entity (its type and canonical form: digits of
a number, lower case of an address or name) gets one surrogate, derived from a secret key by
SHA-256: letters stay letters of their script and case, digits stay digits, separators stay;
hexadecimal secrets stay hexadecimal, card numbers keep their first digit and a right check
digit, bank account numbers their country and right check digits, social security numbers a
number that may be given out, addresses a valid form and their private range, those of
version 6 their first group, AWS keys their prefix. All writings of an entity get the same surrogate, each in its own format.

A person is a title, a phrase that introduces a name, or a known given name, with up to three
words of a name. Each word is an entity of its own, so it has one surrogate whatever stands
before it and wherever in a name it stands. What it is follows from all its mentions: a given
name if it is a known one or once has a surname behind it, its gender that of the known name,
else of most of the titles in its different mentions. All words keep their script. Bare words of the persons that a text
mentions are replaced in it, too, with the same surrogates.

Surrogates are checked: one that equals another entity's surrogate, or any real entity of
the corpus, is drawn anew with the next attempt until all are distinct. After ``WIDEN``
attempts a word is drawn one letter longer, so that crowded forms can't keep it waiting. Only
forms of which there are too few (as addresses of a private range) can run out: what is left
after ``MOST_ATTEMPTS`` is masked, its digits by 0 and its letters by x.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .columns import all_named, free, named, others, place
from .store import written

WIDEN, MOST_ATTEMPTS = 8, 40

#: Titles and given names that carry a gender.
MALE_TITLES = ["Mr", "Herr", "Monsieur", "Señor", "Sr", "господин"]
FEMALE_TITLES = ["Mrs", "Ms", "Miss", "Frau", "Madame", "Mme", "Señora", "Sra", "госпожа"]
OTHER_TITLES = ["Dr", "Prof", "κ", "Δρ", "доктор"]
#: Phrases that a name follows.
PHRASES = ["My name is", "Name:", "Dear", "Signed by", "Sincerely,", "Regards,"]
MALE_NAMES = ["James", "John", "Robert", "Michael", "William", "David", "Thomas", "Daniel", "Paul", "Mark", "Peter", "Hans", "Pierre", "Jean", "Carlos", "José", "Juan", "Miguel", "Klaus", "Stefan"]
FEMALE_NAMES = ["Mary", "Anna", "Linda", "Barbara", "Susan", "Sarah", "Karen", "Laura", "Emma", "Julia", "Maria", "Marie", "Claire", "Sophie", "Carmen", "Elena", "Isabel", "Ursula", "Petra", "Heike"]
LATIN_SYLLABLES = ["ba", "be", "bo", "da", "de", "do", "ka", "ke", "ko", "la", "le", "lo", "ma", "me", "mo", "na", "ne", "no", "ra", "re", "ro", "sa", "se", "so", "ta", "te", "to", "va", "ve", "vo", "wa", "we"]
CYRILLIC_SYLLABLES = ["ба", "бе", "бо", "да", "де", "до", "ка", "ке", "ко", "ла", "ле", "ло", "ма", "ме", "мо", "на", "не", "но", "ра", "ре", "ро", "са", "се", "со", "та", "те", "то", "ва", "ве", "во", "за", "зе"]

#: Of each further script a letter's pattern, the first of a row of letters, and their number.
SCRIPTS = [
    (r"[\p{IsGreek}&&\p{Lu}]", 0x391, 17), (r"[\p{IsGreek}&&\p{Ll}]", 0x3B1, 17), (r"[\p{IsCyrillic}&&\p{Lu}]", 0x410, 32), (r"[\p{IsCyrillic}&&\p{Ll}]", 0x430, 32),
    (r"[\p{IsArmenian}&&\p{Lu}]", 0x531, 38), (r"[\p{IsArmenian}&&\p{Ll}]", 0x561, 38), (r"[\p{IsGeorgian}&&\p{L}]", 0x10D0, 33), (r"[\p{IsHebrew}&&\p{L}]", 0x5D0, 27),
    (r"[\p{IsArabic}&&\p{L}]", 0x628, 19), (r"[\p{IsDevanagari}&&\p{L}]", 0x915, 37), (r"[\p{IsThai}&&\p{L}]", 0xE01, 40), (r"[\p{IsHiragana}&&\p{L}]", 0x304B, 40),
    (r"[\p{IsKatakana}&&\p{L}]", 0x30AB, 40), (r"[\p{IsHangul}&&\p{L}]", 0xAC00, 256), (r"[\p{IsHan}&&\p{L}]", 0x4E00, 256),
]

_OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
_WORD = r"[\p{Lu}\p{Lo}][\p{L}\p{M}’'-]+"
_TITLE = rf"(?:{'|'.join(MALE_TITLES + FEMALE_TITLES + OTHER_TITLES)})\.? "
_BEFORE = rf"(?:(?:{'|'.join(PHRASES)}) (?:{_TITLE})?|{_TITLE})"
_KNOWN = [*MALE_NAMES, *FEMALE_NAMES]
_GIVEN = rf"(?:{'|'.join([*_KNOWN, *(n.upper() for n in _KNOWN)])})"
_HEX = "[0-9A-Fa-f]{1,4}"
#: What a person can begin with, so that the names are tried at few places.
_FIRST = "(?=[A-ZгдκΔ])"
#: In the order in which they are tried; each matches an entity from its first character on.
PATTERNS = {
    "email": r"[A-Za-z0-9][A-Za-z0-9._%+-]{0,63}+@(?:[A-Za-z0-9-]{1,63}\.){1,8}[A-Za-z]{2,24}",
    "aws": r"AKIA[0-9A-Z]{16}\b",
    "secret": r"(?i:token|password|passwd|secret|(?:(?:api|access|secret|private)[_-]?key))\s{0,3}[=:]\s{0,3}\"?[A-Za-z0-9_\-+/.]{6,}+",
    "iban": r"[A-Z]{2}\d{2}(?:(?: ?\d{4}){3,7}| ?[A-Z]{4}(?: ?\d{4}){2,6})(?: ?\d{1,3})?\b",
    "ipv6": rf"(?<![:.])(?:(?:{_HEX}:){{7}}{_HEX}|[23fF][0-9A-Fa-f]{{3}}(?::{_HEX}){{0,6}}::(?:{_HEX}(?::{_HEX}){{0,6}})?)(?![0-9A-Za-z:])",
    "card": r"(?<![\d.-])\d{4}(?:[ -]?\d{4}){3}(?![\d-])",
    "ssn": r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])",
    "ip": rf"(?<![\d.]){_OCTET}(?:\.{_OCTET}){{3}}(?!\d|\.\d)",
    "phone": r"(?<![\d+])(?:\+\d{1,3}[ .-]?)?(?:\(\d{2,4}\)|\d{2,4})(?:[ .-]\d{3,4}){2}(?!\d)|\+\d{1,3}(?:[ .-]?\d{2,4}){2,4}(?!\d)",
    "person": rf"{_FIRST}(?:{_BEFORE}{_WORD}(?: {_WORD}){{0,2}}|{_GIVEN}(?: {_WORD}){{1,2}})",
}
#: An entity starts where no ASCII letter or digit is before it, so words are tried once.
ANY = "(?<![A-Za-z0-9])(?:" + "|".join(f"(?:{p})" for p in PATTERNS.values()) + ")"
#: A text without any of these holds no entity; names are tried at capitals only.
HINT = rf"[0-9@=:]|{_FIRST}(?:{_BEFORE}|{_GIVEN} )"
_SECRET_KEY = r"^[A-Za-z_-]+\s{0,3}[=:]\s{0,3}\"?"


def _is(form: Column, kind: str) -> Column:
    bare = PATTERNS[kind].replace(r"(?<![\d.-])", "").replace(r"(?<![\d-])", "").replace(r"(?<![\d.])", "").replace(r"(?<![\d+])", "").replace(r"(?<![:.])", "")
    return form.rlike(f"^(?:{bare})$")


def kind_of(form: Column) -> Column:
    return F.coalesce(*(F.when(_is(form, k), F.lit(k)) for k in PATTERNS), F.lit("secret"))


def _digits(c: Column) -> Column:
    return F.regexp_replace(c, r"\D", "")


def _gender(form: Column) -> Column:
    """What the title of a mention says, 0 for none, 1 for male, -1 for female."""
    starts = lambda words: form.rlike(f"(?:^| )(?:{'|'.join(words)})\\.? ")
    return F.when(starts(FEMALE_TITLES), -1).when(starts(MALE_TITLES), 1).otherwise(0)


def _name_of(form: Column) -> Column:
    return F.regexp_replace(form, f"^{_BEFORE}", "")


def parts_of(kind: Column, form: Column) -> Column:
    """The entities (kind, canonical) in a mention, canonical being what all writings of one
    share; of a name's words also what the mention says of each: given (whether a word follows)
    and gender."""
    digits = _digits(form)
    canonical = (
        F.when(kind.isin("email", "ipv6"), F.lower(form))
        .when(kind == "secret", F.regexp_replace(form, _SECRET_KEY, ""))
        .when(kind == "phone", F.when((F.length(digits) == 11) & digits.startswith("1"), F.expr("substring(regexp_replace(form, '\\\\D', ''), 2)")).otherwise(digits))
        .when(kind.isin("card", "ssn"), digits)
        .when(kind == "iban", F.regexp_replace(form, " ", ""))
        .otherwise(form)
    )
    words, none = F.split(_name_of(form), " "), F.lit(0)
    part = lambda k, c, given, gender: F.struct(k.alias("kind"), c.alias("canonical"), given.alias("given"), gender.alias("gender"))
    person = F.transform(words, lambda w, at: part(F.lit("name"), F.lower(w), (at + 1 < F.size(words)).cast("int"), _gender(form)))
    return F.when(kind == "person", person).otherwise(F.array(part(kind, canonical, none, none)))


def _let(value: Column, body) -> Column:
    """The body of the value, which is computed once however often the body names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _stream(key: str, *seed: Column, text: Column | None = None) -> Column:
    """Hexadecimal bytes that only the key and seed decide, in blocks of 32: three blocks, or
    as many as it takes to give each character of a longer text its own byte."""
    block = lambda b, *s: F.sha2(F.concat_ws("|", F.lit(key), b.cast("string"), *(x.cast("string") for x in s)), 256)
    three = F.array(*(block(F.lit(b), *seed) for b in range(3)))
    if text is None:
        return three
    last = F.shiftright(F.length(text) - 1, 5)
    more = lambda first: F.concat(first, F.transform(F.sequence(F.lit(3), last), lambda b: block(b, F.element_at(first, 1))))
    return F.when(last > 2, _let(three, more)).otherwise(three)


def _byte(stream: Column, at: Column) -> Column:
    place = at % (F.size(stream) * 32)
    return F.conv(F.substr(F.element_at(stream, F.shiftright(place, 5) + 1), place % 32 * 2 + 1, F.lit(2)), 16, 10).cast("int")


def _letters(text: Column, stream: Column, alphabet: Column | int = 26) -> Column:
    """Every letter and digit of the text replaced by one of its kind; letters are of the
    first ``alphabet`` ones."""
    chars = F.split(text, "")

    def one(c: Column, at: Column, bytes_: Column, letters: Column) -> Column:
        pick = lambda first, n: F.chr(F.lit(ord(first)) + _byte(bytes_, at) % n)
        return F.when(c.rlike("^[0-9]$"), pick("0", 10)).when(c.rlike("^[a-z]$"), pick("a", letters)).when(c.rlike("^[A-Z]$"), pick("A", letters)).otherwise(c)

    alphabet = F.lit(alphabet) if isinstance(alphabet, int) else alphabet
    return _let(F.struct(stream.alias("bytes"), alphabet.alias("letters")), lambda x: F.array_join(F.transform(chars, lambda c, at: one(c, at, x["bytes"], x["letters"])), ""))


def _luhn(first: Column) -> Column:
    """The check digit behind the digits."""
    value = lambda c, at: F.when(at % 2 == 0, F.when(c * 2 > 9, c * 2 - 9).otherwise(c * 2)).otherwise(c)
    digits = F.transform(F.split(F.reverse(first), ""), lambda c, at: value(c.cast("int"), at))
    return ((10 - F.aggregate(digits, F.lit(0), lambda a, x: a + x) % 10) % 10).cast("string")


def _in_script(text: Column, stream: Column) -> Column:
    """Every letter of the text replaced by one of its script and case; marks and the rest stay."""
    rows = [(pattern, "".join(chr(first + k) for k in range(n) if chr(first + k).isalpha())) for pattern, first, n in SCRIPTS]

    def one(c: Column, at: Column) -> Column:
        row = F.lit(None).cast("string")
        for pattern, letters in reversed(rows):
            row = F.when(c.rlike(pattern), F.lit(letters)).otherwise(row)
        return _let(row, lambda r: F.coalesce(F.substr(r, _byte(stream, at) % F.length(r) + 1, F.lit(1)), c))

    return F.array_join(F.transform(F.split(text, ""), one), "")


def _name(stream: Column, given: Column, gender: Column, word: Column, attempt: Column) -> Column:
    """Of a given name (gender m, f or x) or surname: a known given name in the first attempts,
    else an invented word with the ending of its gender; in further scripts letter by letter."""
    cyrillic, latin = word.rlike(r"\p{IsCyrillic}"), word.rlike(r"\p{IsLatin}")
    female = F.when(given, gender == "f").otherwise(word.endswith("а"))
    known = F.element_at(F.when(gender == "f", F.lit(FEMALE_NAMES)).when(gender == "m", F.lit(MALE_NAMES)).otherwise(F.lit(_KNOWN)), _byte(stream, F.lit(9)) % F.when(gender == "x", 40).otherwise(20) + 1)
    latin_end = F.when(~given, "n").when(female, "na").otherwise("r")
    cyrillic_end = F.when(given, F.when(female, "на").otherwise("р")).otherwise(F.when(female, "ова").otherwise("ов"))
    syllables = F.transform(F.sequence(F.lit(1), F.when(attempt >= 2 * WIDEN, 5).when(attempt >= WIDEN, 4).otherwise(3)), lambda k: F.element_at(F.when(cyrillic, F.lit(CYRILLIC_SYLLABLES)).otherwise(F.lit(LATIN_SYLLABLES)), _byte(stream, k) % 32 + 1))
    invented = F.concat(F.array_join(syllables, ""), F.when(cyrillic, cyrillic_end).otherwise(latin_end))
    longer = F.when(attempt >= WIDEN, F.concat(word, F.substring(word, 1, 1))).otherwise(word)
    return F.when(~cyrillic & ~latin, _in_script(longer, stream)).when(given & latin & (attempt < WIDEN // 2), F.lower(known)).otherwise(invented)


def _ssn(stream: Column) -> Column:
    """Nine digits: no area of 000, 666 or from 900 on, no group of 00, no serial of 0000."""
    number = lambda k: _byte(stream, F.lit(k)) * 256 + _byte(stream, F.lit(k + 1))
    area = number(60) % 898 + 1
    area = F.when(area >= 666, area + 1).otherwise(area)
    return F.concat(F.lpad(area.cast("string"), 3, "0"), F.lpad((number(62) % 99 + 1).cast("string"), 2, "0"), F.lpad((number(64) % 9999 + 1).cast("string"), 4, "0"))


def _iban(country: Column, account: Column) -> Column:
    """Country, check digits, account: the rest by 97 of account, country and check is 1, letters
    counting from 10."""
    value = lambda c: F.when(c.rlike("[A-Z]"), (F.ascii(c) - 55).cast("string")).otherwise(c)
    digits = F.array_join(F.transform(F.split(F.concat(account, country, F.lit("00")), ""), value), "")
    rest = F.aggregate(F.split(digits, ""), F.lit(0), lambda a, d: (a * 10 + d.cast("int")) % 97)
    return F.concat(country, F.lpad((98 - rest).cast("string"), 2, "0"), account)


def surrogate_of(key: str) -> Column:
    """Of the columns kind, canonical, given, gender and attempt."""
    kind, canonical, attempt = F.col("kind"), F.col("canonical"), F.col("attempt")
    stream = _stream(key, kind, attempt, canonical)
    local, domain = F.substring_index(canonical, "@", 1), F.substring_index(canonical, "@", -1)
    hosts = F.regexp_replace(domain, r"\.[a-z]+$", "")
    widened = F.when(attempt >= WIDEN, _letters(F.lit("aa"), F.reverse(stream))).otherwise("")
    email = F.concat(_letters(local, stream), widened, F.lit("@"), _letters(hosts, _stream(key, F.lit("domain"), domain)), F.regexp_extract(domain, r"(\.[a-z]+)$", 1))
    card = F.concat(F.substring(canonical, 1, 1), F.expr("substring(drawn, 2, length(drawn) - 2)"))
    within = lambda head, n: F.concat_ws(".", F.lit(head), *(octet(k) for k in range(4 - n, 4)))
    octet = lambda k: (_byte(stream, F.lit(k)) % 254 + 1).cast("string")
    public = F.element_at(F.lit([x for x in range(11, 224) if x not in (127, 169, 172, 192)]), _byte(stream, F.lit(40)) % 208 + 1).cast("string")
    phone = F.when(F.length(canonical) == 10, F.concat((_byte(stream, F.lit(50)) % 8 + 2).cast("string"), F.expr("substring(drawn, 2)"))).otherwise(F.col("drawn"))
    return (
        F.when(kind == "email", email)
        .when(kind == "card", F.concat(card, _luhn(card)))
        .when(kind == "ip", F.when(canonical.startswith("192.168."), within("192.168", 2)).when(canonical.startswith("10."), within("10", 3)).when(canonical.rlike(r"^172\.(?:1[6-9]|2\d|3[01])\."), F.concat_ws(".", F.lit("172"), (_byte(stream, F.lit(41)) % 16 + 16).cast("string"), octet(2), octet(3))).otherwise(F.concat_ws(".", public, octet(1), octet(2), octet(3))))
        .when(kind == "ipv6", F.concat(F.regexp_extract(canonical, "^([^:]+)", 1), F.regexp_extract("drawn", "(:.*)$", 1)))
        .when(kind == "phone", phone)
        .when(kind == "aws", F.concat(F.lit("AKIA"), F.expr("substring(drawn, 5)")))
        .when(kind == "iban", _iban(F.substring(canonical, 1, 2), F.expr("substring(drawn, 5)")))
        .when(kind == "ssn", _ssn(stream))
        .when(kind == "name", _name(stream, F.col("given"), F.col("gender"), canonical, attempt))
        .otherwise(F.col("drawn"))
    )


def surrogates(entities: DataFrame, key: str) -> DataFrame:
    """(kind, canonical, surrogate): distinct within a kind, and none a real entity. Entities
    have what each mention says of them: given and gender."""
    known = lambda names: F.col("canonical").isin([n.lower() for n in names])
    real = entities.groupBy("kind", "canonical").agg(F.max("given").alias("follows"), F.sum("gender").alias("titles"))
    gender = F.when(known(MALE_NAMES), "m").when(known(FEMALE_NAMES), "f").when(F.col("titles") > 0, "m").when(F.col("titles") < 0, "f").otherwise("x")
    real = written(real.select("kind", "canonical", ((F.col("follows") > 0) | known(_KNOWN)).alias("given"), gender.alias("gender")), "entities")
    waiting, done, attempt = real, [], 0
    while attempt < MOST_ATTEMPTS and not waiting.isEmpty():
        stream = _stream(key, F.col("kind"), F.lit(attempt), F.col("canonical"), text=F.col("canonical"))
        hexadecimal = (F.col("kind") == "ipv6") | (F.col("kind") == "secret") & F.col("canonical").rlike("^(?:[0-9a-f]+|[0-9A-F]+)$")
        drawn = waiting.withColumn("attempt", F.lit(attempt)).withColumn("drawn", _letters(F.col("canonical"), stream, F.when(hexadecimal, 6).otherwise(26)))
        tried = drawn.withColumn("surrogate", surrogate_of(key)).select("kind", "canonical", "surrogate")
        taken = reduce(DataFrame.unionByName, [real.select("kind", F.lower("canonical").alias("low")), *(d.select("kind", F.lower("surrogate").alias("low")) for d in done)])
        free = tried.withColumn("low", F.lower("surrogate")).join(taken, ["kind", "low"], "left_anti")
        won = free.groupBy("kind", "low").agg(F.min(F.struct("canonical", "surrogate")).alias("w")).select("kind", "w.canonical", "w.surrogate")
        done.append(written(won, "surrogates"))
        waiting = written(waiting.join(done[-1], ["kind", "canonical"], "left_anti"), "waiting")
        attempt += 1
    masked = F.regexp_replace("canonical", r"\p{L}", "x")
    done.append(waiting.select("kind", "canonical", F.regexp_replace(masked, "[0-9]", "0").alias("surrogate")))
    return reduce(DataFrame.unionByName, done)


def written_as(form: Column) -> Column:
    """The surrogates in the format of the mention. Columns: kind, form, found (surrogates in
    the order of the mention's entities)."""
    kind, out = F.col("kind"), F.col("found")[0]
    chars = F.split(form, "")
    # The last digits of the mention are the entity's; a country code before them stays.
    behind = lambda at: F.length(_digits(F.substr(form, at + 2, F.length(form))))
    place = lambda at: F.length(out) - behind(at)
    numbers = F.array_join(F.transform(chars, lambda c, at: F.when(c.rlike("^[0-9]$") & (place(at) >= 1), F.substr(out, place(at), F.lit(1))).otherwise(c)), "")
    spaced = F.array_join(F.transform(chars, lambda c, at: F.when(c == " ", c).otherwise(F.substr(out, F.length(F.regexp_replace(F.substr(form, F.lit(1), at + 1), " ", "")), F.lit(1)))), "")
    words = F.split(_name_of(form), " ")
    shaped = F.zip_with("found", words, lambda f, w: F.when((F.length(w) > 1) & (F.upper(w) == w) & (F.lower(w) != w), F.upper(f)).otherwise(F.initcap(f)))
    person = F.concat(F.regexp_extract(form, f"^({_BEFORE})", 1), F.array_join(shaped, " "))
    cased = F.when(F.upper(form) == form, F.upper(out)).otherwise(out)
    return (
        F.when(kind.isin("phone", "card", "ssn"), numbers)
        .when(kind == "iban", spaced)
        .when(kind == "secret", F.concat(F.regexp_extract(form, f"({_SECRET_KEY})", 1), out))
        .when(kind == "person", person)
        .when(kind.isin("email", "ipv6"), cased)
        .otherwise(out)
    )


def replaced(docs: DataFrame, key: str, text_col: str = "text", count_col: str = "n_entities") -> DataFrame:
    """``docs``, all columns, entities in the text replaced, and the number of mentions, bare
    words of persons included.

    A null or empty text stays as it is, with no mention. Rows need no id: equal texts get
    equal results, whatever their other columns; repeated rows stay. A column of ``docs``
    named like ``count_col`` is replaced by the number; any other name may occur.
    """
    columns = others(docs.columns, count_col)
    text_col = columns[place(columns, text_col)]
    base = docs.select(*all_named(columns)).withColumn(text_col, named(text_col).cast("string"))
    mentions, digest, swap_col, words_col = (free(columns, f"__{c}") for c in ("found", "text", "swaps", "words"))
    # A filter only asks whether there is a mention, and stops at the first; mentions are
    # gathered from the texts that have any.
    holds = F.coalesce(F.col(text_col).rlike(HINT) & F.col(text_col).rlike(ANY), F.lit(False))
    found = base.where(holds).withColumns({mentions: F.regexp_extract_all(F.col(text_col), F.lit(ANY), F.lit(0)), digest: F.xxhash64(text_col)})
    some = written(found, "mentions")
    forms = some.select(F.col(digest).alias("digest"), F.explode(F.array_distinct(mentions)).alias("form")).distinct()
    kinds = forms.select("form").distinct().withColumn("kind", kind_of(F.col("form"))).withColumn("parts", parts_of(F.col("kind"), F.col("form")))
    kinds = written(kinds, "forms")
    parts = kinds.select("form", F.col("kind").alias("of"), F.posexplode("parts").alias("pos", "part")).select("form", "of", "pos", "part.*")
    by_form = parts.drop("given", "gender").join(surrogates(parts, key), ["kind", "canonical"]).groupBy("form", F.col("of").alias("kind")).agg(F.array_sort(F.collect_list(F.struct("pos", "surrogate"))).alias("s"))
    words = F.when(F.col("kind") == "person", F.arrays_zip(F.split(_name_of(F.col("form")), " ").alias("word"), F.split(_name_of(F.col("swap")), " ").alias("swap")))
    swaps = by_form.withColumn("found", F.col("s.surrogate")).select("form", "kind", written_as(F.col("form")).alias("swap")).select("form", "swap", words.alias("words"))
    # A text's mentions are no more than the text; equal texts share one entry. Written apart
    # from the join, so that Spark can split the rows of a very common text.
    by_text = forms.join(swaps, "form").groupBy(F.col("digest").alias(digest)).agg(F.map_from_entries(F.collect_list(F.struct("form", "swap"))).alias(swap_col), F.array_distinct(F.flatten(F.collect_list("words"))).alias(words_col))
    by_text = written(by_text, "swaps")
    between = F.split(F.col(text_col), ANY, -1)
    swapped = F.transform(F.col(mentions), lambda m: F.coalesce(F.element_at(F.col(swap_col), m), m))
    # Bare words of the persons in the text. A surrogate is no real name, so none is replaced twice.
    alone = lambda w: F.concat(F.lit(r"(?<![\p{L}\p{M}])"), w["word"], F.lit(r"(?![\p{L}\p{M}])"))
    hits = F.aggregate(F.col(words_col), F.lit(0), lambda n, w: n + F.aggregate(between, F.lit(0), lambda k, x: k + F.regexp_count(x, alone(w))))
    cleaned = F.transform(between, lambda x: F.aggregate(F.col(words_col), x, lambda t, w: F.regexp_replace(t, alone(w), w["swap"])))
    some = some.join(by_text.hint("merge"), digest).withColumns({count_col: F.size(mentions) + F.when(F.size(words_col) > 0, hits).otherwise(0), words_col: F.when(F.size(words_col) > 0, cleaned).otherwise(between)})
    pieces = F.zip_with(swapped, F.slice(words_col, 2, F.size(mentions)), lambda m, rest: F.concat(m, rest))
    done = some.withColumn(text_col, F.concat(F.element_at(words_col, 1), F.array_join(pieces, "")))
    rest = base.where(~holds).withColumn(count_col, F.lit(0))
    return done.select(*all_named(columns), named(count_col)).unionByName(rest)
