"""Names, tables and patterns that the rules are defined by."""

MISSING_ODDS = ["", "-", "N/A", "nan", "NaN"]

MONTHS_PT = {"jan": 1, "fev": 2, "mar": 3, "abr": 4, "mai": 5, "jun": 6, "jul": 7, "ago": 8, "set": 9, "out": 10, "nov": 11, "dez": 12}

COUNTRY_NAMES = {
    "usa": "USA",
    "uae": "UAE",
    "united-arab-emirates": "UAE",
    "united-kingdom": "UK",
    "south-korea": "South Korea",
    "south-africa": "South Africa",
    "czech-republic": "Czech Republic",
    "new-zealand": "New Zealand",
    "saudi-arabia": "Saudi Arabia",
    "ivory-coast": "Ivory Coast",
    "trinidad-tobago": "Trinidad and Tobago",
}

TOURNAMENT_PREFIXES = ["atp-", "wta-", "challenger-", "itf-m15-", "itf-w15-", "itf-m25-", "itf-w25-", "itf-m50-", "itf-w50-", "itf-m100-", "itf-w100-"]
TOURNAMENT_SUFFIXES = ["-open", "-masters", "-challenger", "-homens", "-mulheres", "-duplas", "-1", "-2", "-3", "-4"]

GRAND_SLAMS = [
    "australia/atp-australian-open", "australia/wta-australian-open", "france/atp-aberto-da-franca", "france/wta-aberto-da-franca",
    "united-kingdom/atp-wimbledon", "united-kingdom/wta-wimbledon", "usa/atp-us-open", "usa/wta-us-open",
]
MASTERS = [
    "usa/atp-indian-wells", "usa/atp-miami", "monaco/atp-monte-carlo", "spain/atp-madri", "italy/atp-roma", "canada/atp-montreal", "canada/atp-toronto",
    "usa/atp-cincinnati", "china/atp-xangai", "france/atp-paris", "usa/wta-indian-wells", "usa/wta-miami", "spain/wta-madri", "italy/wta-roma",
    "canada/wta-montreal", "canada/wta-toronto", "usa/wta-cincinnati", "china/wta-wuhan", "china/wta-beijing",
]
TIER_500 = [
    "netherlands/atp-roterda", "united-arab-emirates/atp-dubai", "mexico/atp-acapulco", "spain/atp-barcelona", "germany/atp-hamburgo", "germany/atp-halle",
    "germany/atp-munique", "usa/atp-washington", "japan/atp-tokyo", "china/atp-beijing", "switzerland/atp-basel", "austria/atp-viena", "germany/atp-stuttgart",
    "australia/wta-adelaide", "usa/wta-charleston", "germany/wta-stuttgart", "united-arab-emirates/wta-dubai", "usa/wta-washington", "qatar/wta-doha",
    "russia/wta-moscou", "japan/wta-tokyo", "china/wta-shenzhen",
]

#: Cities of leagues whose path doesn't spell them.
CITIES = {
    "france/atp-aberto-da-franca": "Paris", "france/wta-aberto-da-franca": "Paris", "australia/atp-australian-open": "Melbourne", "australia/wta-australian-open": "Melbourne",
    "united-kingdom/atp-wimbledon": "Wimbledon", "united-kingdom/wta-wimbledon": "Wimbledon", "usa/atp-us-open": "New York", "usa/wta-us-open": "New York",
    "usa/atp-indian-wells": "Indian Wells", "usa/wta-indian-wells": "Indian Wells", "usa/atp-miami": "Miami", "usa/wta-miami": "Miami",
    "usa/atp-cincinnati": "Cincinnati", "usa/wta-cincinnati": "Cincinnati", "monaco/atp-monte-carlo": "Monte Carlo", "spain/atp-madri": "Madrid", "spain/wta-madri": "Madrid",
    "italy/atp-roma": "Rome", "italy/wta-roma": "Rome", "canada/atp-toronto": "Toronto", "canada/atp-montreal": "Montreal", "canada/wta-toronto": "Toronto", "canada/wta-montreal": "Montreal",
    "china/atp-xangai": "Shanghai", "china/wta-wuhan": "Wuhan", "china/wta-beijing": "Beijing", "france/atp-paris": "Paris",
    "netherlands/atp-roterda": "Rotterdam", "united-arab-emirates/atp-dubai": "Dubai", "united-arab-emirates/wta-dubai": "Dubai", "mexico/atp-acapulco": "Acapulco",
    "spain/atp-barcelona": "Barcelona", "germany/atp-hamburgo": "Hamburg", "germany/atp-halle": "Halle", "germany/atp-munique": "Munich", "germany/atp-stuttgart": "Stuttgart",
    "usa/atp-washington": "Washington", "usa/atp-houston": "Houston", "usa/wta-washington": "Washington", "usa/atp-new-haven": "New Haven", "usa/wta-new-haven": "New Haven",
    "japan/atp-tokyo": "Tokyo", "japan/wta-tokyo": "Tokyo", "china/atp-beijing": "Beijing", "switzerland/atp-basel": "Basel", "switzerland/atp-genebra": "Geneva", "austria/atp-viena": "Vienna",
    "qatar/atp-doha": "Doha", "qatar/wta-doha": "Doha", "usa/wta-charleston": "Charleston", "germany/wta-stuttgart": "Stuttgart", "russia/wta-moscou": "Moscow",
    "russia/atp-moscou": "Moscow", "russia/atp-sao-petersburgo": "St. Petersburg", "russia/wta-sao-petersburgo": "St. Petersburg", "brazil/atp-rio-de-janeiro": "Rio de Janeiro",
    "argentina/atp-buenos-aires": "Buenos Aires", "india/atp-pune": "Pune", "india/atp-chennai": "Chennai", "south-korea/atp-seul": "Seoul", "south-korea/wta-seul": "Seoul",
    "sweden/atp-estocolmo": "Stockholm", "belgium/atp-antuerpia": "Antwerp", "croatia/atp-zagreb": "Zagreb", "croatia/atp-umag": "Umag", "serbia/atp-belgrado": "Belgrade",
    "greece/atp-atenas": "Athens", "chile/atp-santiago": "Santiago", "ecuador/atp-quito": "Quito", "colombia/atp-bogota": "Bogota", "portugal/atp-estoril": "Estoril", "portugal/wta-estoril": "Estoril",
    "czech-republic/wta-praga": "Prague", "czech-republic/atp-praga": "Prague", "hungary/atp-budapeste": "Budapest", "hungary/wta-budapeste": "Budapest", "poland/atp-varsovia": "Warsaw",
    "thailand/wta-pattaya": "Pattaya", "bahrain/atp-bahrein": "Manama", "spain/atp-valencia": "Valencia", "israel/atp-tel-aviv": "Tel Aviv", "kazakhstan/atp-astana": "Astana",
    "turkey/atp-antalya": "Antalya", "turkey/atp-istambul": "Istanbul", "austria/atp-kitzbuhel": "Kitzbuhel", "romania/atp-bucareste": "Bucharest", "romania/wta-bucareste": "Bucharest",
    "australia/atp-adelaide": "Adelaide", "australia/wta-adelaide": "Adelaide", "australia/atp-sydney": "Sydney", "australia/wta-sydney": "Sydney", "australia/atp-brisbane": "Brisbane",
    "australia/wta-brisbane": "Brisbane", "australia/wta-hobart": "Hobart", "new-zealand/atp-auckland": "Auckland", "new-zealand/wta-auckland": "Auckland",
    "china/atp-shenzhen": "Shenzhen", "china/wta-shenzhen": "Shenzhen", "china/atp-chengdu": "Chengdu", "china/wta-zhuhai": "Zhuhai", "china/wta-guangzhou": "Guangzhou", "china/wta-tianjin": "Tianjin",
    "mexico/wta-guadalajara": "Guadalajara", "mexico/atp-los-cabos": "Los Cabos", "japan/wta-hiroshima": "Hiroshima", "japan/atp-hiroshima": "Hiroshima", "japan/wta-osaka": "Osaka", "india/wta-pune": "Pune",
    "south-africa/atp-joanesburgo": "Johannesburg", "france/atp-lyon": "Lyon", "france/wta-estrasburgo": "Strasbourg", "france/atp-marselha": "Marseille",
    "netherlands/atp-s-hertogenbosch": "s-Hertogenbosch", "netherlands/wta-s-hertogenbosch": "s-Hertogenbosch", "united-kingdom/atp-eastbourne": "Eastbourne", "united-kingdom/wta-eastbourne": "Eastbourne",
    "united-kingdom/wta-birmingham": "Birmingham", "united-kingdom/atp-nottingham": "Nottingham", "serbia/wta-belgrado": "Belgrade", "italy/wta-palermo": "Palermo",
    "usa/wta-san-diego": "San Diego", "usa/wta-cleveland": "Cleveland", "usa/wta-palm-springs": "Palm Springs", "usa/atp-dallas": "Dallas", "usa/atp-delray-beach": "Delray Beach",
    "usa/atp-san-jose": "San Jose", "usa/wta-san-jose": "San Jose", "usa/atp-winston-salem-eua": "Winston-Salem", "usa/atp-atlanta": "Atlanta", "usa/atp-newport": "Newport", "usa/atp-los-angeles": "Los Angeles",
    "kazakhstan/wta-astana": "Astana", "ukraine/itf-w25-kyiv-mulheres": "Kyiv",
}

#: alias: (sport, path)
LEAGUE_ALIASES = {
    "nba": ("basketball", "usa/nba"),
    "euroleague": ("basketball", "europe/euroleague"),
    "premier-league": ("soccer", "england/premier-league"),
    "la-liga": ("soccer", "spain/laliga"),
    "serie-a": ("soccer", "italy/serie-a"),
    "bundesliga": ("soccer", "germany/bundesliga"),
    "ligue-1": ("soccer", "france/ligue-1"),
    "atp": ("tennis", "atp-singles"),
    "wta": ("tennis", "wta-singles"),
    "ufc": ("mma", "ufc"),
    "nhl": ("hockey", "usa/nhl"),
    "mlb": ("baseball", "usa/mlb"),
    "nfl": ("american-football", "usa/nfl"),
}

#: market, tab label, tab slug, has lines
MARKETS = [
    ("1x2", "1X2", "", False),
    ("home_away", "Home/Away", "", False),
    ("over_under", "Acima/Abaixo", "over-under", True),
    ("asian_handicap", "Handicap Asiático", "asian-handicap", True),
    ("european_handicap", "Handicap Europeu", "european-handicap", True),
    ("draw_no_bet", "Draw No Bet", "draw-no-bet", False),
    ("double_chance", "Double Chance", "double-chance", False),
    ("btts", "Ambas equipes marcam", "both-teams-to-score", False),
    ("odd_even", "Par ou Ímpar", "odd-or-even", False),
    ("correct_score", "Resultado correto", "correct-score", False),
    ("ht_ft", "Intervalo/Final do jogo", "half-time-full-time", False),
    ("total_sets", "Total de Sets", "total-sets", True),
    ("total_games", "Total de Games", "total-games", True),
    ("exact_score", "Resultado correto", "correct-score", False),
    ("placar_exato", "Placar exato", "correct-score", False),
    ("method_of_victory", "Método de Vitória", "method-of-victory", False),
]

#: market, line, outcome, key
MARKET_KEYS = [
    ("1x2", "", "home", "H_FT"),
    ("1x2", "", "draw", "D_FT"),
    ("1x2", "", "away", "A_FT"),
    ("1x2_ht", "", "home", "H_HT"),
    ("double_chance", "", "1x", "1X_FT"),
    ("double_chance", "", "x2", "X2_FT"),
    ("over_under", "1.5", "over", "Over15_FT"),
    ("over_under", "2.5", "over", "Over25_FT"),
    ("over_under", "3.5", "over", "Over35_FT"),
    ("over_under", "1.5", "under", "Under15_FT"),
    ("over_under", "2.5", "under", "Under25_FT"),
    ("btts", "", "yes", "BTTS_Yes"),
    ("btts", "", "no", "BTTS_No"),
]

OUTCOMES = {
    "1x2": ["home", "draw", "away"],
    "home_away": ["home", "away"],
    "double_chance": ["1x", "12", "x2"],
    "draw_no_bet": ["home", "away"],
    "btts": ["yes", "no"],
    "odd_even": ["odd", "even"],
}

#: Values of data-testid in the pages, and the class of a participant's name.
TEST_IDS = {
    "date_header": ["date-header", "secondary-header"],
    "game_row": ["game-row"],
    "time": ["time-item"],
    "participants": ["event-participants"],
    "participant": ["participant-name"],
    "score": ["result-score", "score"],
    "odds_row": ["over-under-expanded-row"],
    "bookmaker": ["outrights-expanded-bookmaker-name"],
    "odd": ["odd-container"],
    "payout": ["payout-container"],
    "line_header": ["line-header", "handicap-row", "total-row"],
    "best_row": ["over-under-collapsed-row"],
    "best_label": ["over-under-collapsed-option-box"],
    "best_odd": ["odd-container-default"],
    "grid_header": ["bookmaker-table-header-line"],
    "host": ["game-host"],
    "guest": ["game-guest"],
    "game_time": ["game-time-item"],
    "live": ["live-info"],
    "game_participants": ["game-participants"],
}
LINE_ATTRIBUTES = ["data-line", "data-total", "data-handicap"]

#: Names in free-form dates, and names of zones that are passed over.
MONTHS_EN = ["january", "february", "march", "april", "may", "june", "july", "august", "september", "october", "november", "december"]
WEEKDAYS_EN = ["monday", "tuesday", "wednesday", "thursday", "friday", "saturday", "sunday"]
ZONES = ["utc", "gmt", "est", "edt", "cst", "cdt", "mst", "mdt", "pst", "pdt", "wet", "west", "cet", "cest", "eet", "eest", "brt", "bst", "jst"]
