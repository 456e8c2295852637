"""Categories, code tables, word lists and thresholds.

They must equal the published behaviour that the engine reproduces, so they
stand here plainly, each in one place.
"""

from __future__ import annotations

# Categories by pillar, in their natural order.
GEOPOLITICAL = (
    "warArmedConflict", "militaryMovement", "terrorismSecurityIncident", "electionPoliticalTransition",
    "protestCivilUnrest", "diplomaticNegotiation", "sanctionsTradeRestriction", "internationalDispute",
)
ECONOMIC = ("centralBankDecision", "macroDataRelease", "fiscalPolicy", "bankingFinancialSystem", "majorCorporateEvent")
PHYSICAL = ("oilEnergyDisruption", "shippingMaritimeDisruption", "aviationDisruption", "earthquakeTsunami", "hurricaneExtremeWeather", "majorFireIndustrialAccident")
CATEGORIES = (*GEOPOLITICAL, *ECONOMIC, *PHYSICAL)
PILLAR = {c: p for p, cs in (("geopolitical", GEOPOLITICAL), ("economic", ECONOMIC), ("physical", PHYSICAL)) for c in cs}
COMPAT_SAME, COMPAT_PILLAR, COMPAT_CROSS = 1.0, 0.5, 0.1

# Half-life of a category's score, in hours.
HALF_LIFE = {
    "warArmedConflict": 240.0,
    "militaryMovement": 120.0,
    "terrorismSecurityIncident": 120.0,
    "electionPoliticalTransition": 48.0,
    "protestCivilUnrest": 48.0,
    "diplomaticNegotiation": 120.0,
    "sanctionsTradeRestriction": 120.0,
    "internationalDispute": 240.0,
    "centralBankDecision": 24.0,
    "macroDataRelease": 24.0,
    "fiscalPolicy": 24.0,
    "bankingFinancialSystem": 24.0,
    "majorCorporateEvent": 12.0,
    "oilEnergyDisruption": 12.0,
    "shippingMaritimeDisruption": 12.0,
    "aviationDisruption": 12.0,
    "earthquakeTsunami": 6.0,
    "hurricaneExtremeWeather": 6.0,
    "majorFireIndustrialAccident": 6.0,
}

# Two-digit event root code: category and severity coefficient.
ROOTS = {
    "01": ("diplomaticNegotiation", 0.2), "02": ("diplomaticNegotiation", 0.2), "03": ("diplomaticNegotiation", 0.2),
    "04": ("diplomaticNegotiation", 0.25), "05": ("diplomaticNegotiation", 0.25), "06": ("diplomaticNegotiation", 0.3),
    "07": ("diplomaticNegotiation", 0.3), "08": ("diplomaticNegotiation", 0.3), "09": ("internationalDispute", 0.35),
    "10": ("diplomaticNegotiation", 0.4), "11": ("internationalDispute", 0.4), "12": ("internationalDispute", 0.45),
    "13": ("internationalDispute", 0.55), "14": ("protestCivilUnrest", 0.5), "15": ("militaryMovement", 0.65),
    "16": ("sanctionsTradeRestriction", 0.55), "17": ("sanctionsTradeRestriction", 0.65), "18": ("terrorismSecurityIncident", 0.85),
    "19": ("warArmedConflict", 1.0), "20": ("terrorismSecurityIncident", 1.0),
}
QUAD = {4: 1.0, 3: 0.6, 2: 0.4, 1: 0.3}
QUAD_OTHER = 0.3

# FIPS country code: ISO alpha-2 code.
FIPS = {
    "AF": "AF", "AG": "DZ", "AR": "AR", "AS": "AU", "AU": "AT", "BA": "BH", "BE": "BE", "BG": "BD", "BM": "MM", "BO": "BY",
    "BR": "BR", "CA": "CA", "CB": "KH", "CD": "CD", "CE": "LK", "CH": "CN", "CL": "CL", "CO": "CO", "DA": "DK", "DJ": "DJ",
    "EG": "EG", "EI": "IE", "ER": "ER", "ET": "ET", "FI": "FI", "FR": "FR", "GB": "GB", "GH": "GH", "GM": "DE", "GR": "GR",
    "HO": "HN", "ID": "ID", "IN": "IN", "IR": "IR", "IS": "IL", "IT": "IT", "IZ": "IQ", "JA": "JP", "JO": "JO", "KE": "KE",
    "KN": "KP", "KS": "KR", "KU": "KW", "LE": "LB", "LY": "LY", "MO": "MA", "MU": "OM", "MX": "MX", "MY": "MY", "NI": "NG",
    "NL": "NL", "NO": "NO", "NP": "NP", "NZ": "NZ", "PE": "PE", "PK": "PK", "PL": "PL", "PO": "PT", "QA": "QA", "RP": "PH",
    "RS": "RU", "SA": "SA", "SF": "ZA", "SN": "SG", "SO": "SO", "SP": "ES", "SU": "SD", "SW": "SE", "SY": "SY", "SZ": "CH",
    "TH": "TH", "TS": "TN", "TU": "TR", "TW": "TW", "TZ": "TZ", "UAE": "AE", "UG": "UG", "UK": "GB", "UP": "UA", "US": "US",
    "VE": "VE", "VM": "VN", "YM": "YE",
}

# Actor types that make an event geopolitical.
ACTOR_TYPES = ("GOV", "MIL", "REB", "INS", "SEP", "UAF", "SPY", "IGO", "IMG")

# Article themes that mark a crisis.
CRISIS_THEMES = (
    "ARMEDCONFLICT", "MILITARY", "TERROR", "REBELS", "UNREST_BELLIGERENT", "SEIGE", "BLOCKADE",
    "CEASEFIRE", "WMD", "SANCTIONS", "CYBER_ATTACK", "WB_2462_POLITICAL_VIOLENCE_AND_WAR", "PROTEST",
)

# Words that a headline's tokens leave out, and capitalised words that name nothing.
TITLE_STOP_WORDS = "a an the and or but of to in on at for with is are was were be been as by from this that".split()
CAPITAL_STOP_WORDS = "The A An In On At For With This".split()

TRACKING_PREFIXES = ("utm_", "fbclid", "gclid", "mc_", "ref", "ref_src", "cmp", "icid")
PUBLISHERS = {
    "reuters.com": "Reuters", "apnews.com": "AP", "bbc.com": "BBC", "bbc.co.uk": "BBC",
    "aljazeera.com": "Al Jazeera", "theguardian.com": "The Guardian", "bloomberg.com": "Bloomberg",
}
BANNED_WORDS = ("bet", "bets", "betting", "odds", "wager", "stake", "trade", "trading")
ENERGY_SERIES = {"WTI": "PET.RWTC.D", "BRENT": "PET.RBRTE.D"}

# Similarity of an event to a situation.
SIM_ENTITY, SIM_GEO, SIM_CATEGORY, SIM_TIME = 0.40, 0.25, 0.20, 0.15
JOIN_THRESHOLD, MERGE_THRESHOLD, VISIBLE_SOURCES = 0.55, 0.75, 3
EARTH_KM, GEO_DECAY_KM = 6371.0, 500.0

# Headline grouping.
DUP_JACCARD, DUP_WEAK_JACCARD, DUP_ENTITY, DUP_HOURS = 0.45, 0.2, 0.5, 6.0

# Scores: news velocity, source confirmation, severity, market and outlook movement.
IMPULSE_WEIGHTS = {"newsVelocity": 0.25, "sourceConfirmation": 0.2, "severity": 0.3, "marketMovement": 0.15, "outlookMovement": 0.1}
VELOCITY_MENTIONS, CONFIRMATION_SOURCES = 300, 50
SEVERITY_FLOOR, SHARED_TOKENS = 0.25, 2
TOP_N, PER_COUNTRY, ACTIVE_HOURS, ARCHIVE_DAYS = 10, 2, 48, 14

# What makes a situation objectively major: two of the four-threshold criteria.
MAJOR_HOURS, MAJOR_SOURCES, MAJOR_SIGMA, MAJOR_POINTS, MAJOR_CRITERIA = 72, 30, 2.0, 15.0, 2

OUTLOOK_STALE_HOURS, OUTLOOK_CONFIDENCE = 6, 0.7
INTERVAL_MINUTES, MAX_INTERVALS, LOOKBACK_INTERVALS = 15, 6, 24
MAX_PUSHES, MAX_WATCHES, SERIES_POINTS, QUOTE_DAYS, CHANGE_DAYS = 3, 50, 96, 30, 14

# Link rules: (id, categories, keywords, both needed, symbols, rationale), first rule wins.
CONFLICT = ("warArmedConflict", "militaryMovement", "internationalDispute", "sanctionsTradeRestriction")
_STRAITS = ("hormuz", "persian gulf", "red sea", "suez", "bab el-mandeb", "bab al-mandab", "gulf of aden")
WATCHABLE_ASSETS = {
    "BTCUSDT": "Bitcoin", "ETHUSDT": "Ethereum", "PAXGUSDT": "Gold (PAXG)", "EURUSD": "EUR/USD", "GBPUSD": "GBP/USD",
    "USDJPY": "USD/JPY", "WTI": "WTI crude oil", "BRENT": "Brent crude oil",
}
ASSET_RULES = (
    ("oil_supply", ("oilEnergyDisruption",), (), False, ("BRENT", "WTI"), "Crude prices follow energy-supply disruption."),
    ("oil_chokepoint", (*CONFLICT, "shippingMaritimeDisruption", "terrorismSecurityIncident"), _STRAITS, True, ("BRENT", "WTI"), "A major oil shipping route is affected."),
    ("safe_haven_conflict", ("warArmedConflict", "militaryMovement"), (), False, ("PAXGUSDT", "USDJPY"), "Gold and the yen are common safe-haven assets during armed conflict."),
    ("rates_and_macro", ("centralBankDecision", "macroDataRelease", "fiscalPolicy"), (), False, ("EURUSD", "GBPUSD", "USDJPY", "PAXGUSDT"), "Policy and data releases move major currencies and gold."),
    ("financial_stress", ("bankingFinancialSystem",), (), False, ("PAXGUSDT", "USDJPY", "BTCUSDT"), "Banking stress can shift demand toward gold, the yen and crypto."),
)
# Symbol: name, exchange, country.
COMPANIES = {
    "XOM": ("Exxon Mobil", "NYSE", "US"), "CVX": ("Chevron", "NYSE", "US"), "COP": ("ConocoPhillips", "NYSE", "US"),
    "SHEL": ("Shell", "NYSE", "GB"), "BP": ("BP", "NYSE", "GB"), "RELIANCE": ("Reliance Industries", "NSE", "IN"),
    "ONGC": ("Oil and Natural Gas Corporation", "NSE", "IN"), "IOC": ("Indian Oil Corporation", "NSE", "IN"), "BPCL": ("Bharat Petroleum", "NSE", "IN"),
    "LMT": ("Lockheed Martin", "NYSE", "US"), "RTX": ("RTX", "NYSE", "US"), "NOC": ("Northrop Grumman", "NYSE", "US"),
    "GD": ("General Dynamics", "NYSE", "US"), "HAL": ("Hindustan Aeronautics", "NSE", "IN"), "BEL": ("Bharat Electronics", "NSE", "IN"),
    "ZIM": ("ZIM Integrated Shipping", "NYSE", "US"), "MAERSK-B": ("A.P. Moller - Maersk", "CPH", "DK"), "ADANIPORTS": ("Adani Ports and SEZ", "NSE", "IN"),
    "SCI": ("Shipping Corporation of India", "NSE", "IN"), "DAL": ("Delta Air Lines", "NYSE", "US"), "UAL": ("United Airlines", "NASDAQ", "US"),
    "BA": ("Boeing", "NYSE", "US"), "INDIGO": ("InterGlobe Aviation (IndiGo)", "NSE", "IN"), "JPM": ("JPMorgan Chase", "NYSE", "US"),
    "GS": ("Goldman Sachs", "NYSE", "US"), "HDFCBANK": ("HDFC Bank", "NSE", "IN"), "SBIN": ("State Bank of India", "NSE", "IN"),
    "TSM": ("Taiwan Semiconductor (ADR)", "NYSE", "TW"), "NVDA": ("NVIDIA", "NASDAQ", "US"), "INTC": ("Intel", "NASDAQ", "US"),
}
COMPANY_RULES = (
    ("energy_supply", ("oilEnergyDisruption",), (), False, ("XOM", "CVX", "COP", "SHEL", "BP", "RELIANCE", "ONGC", "IOC", "BPCL"), "Oil and gas producers and refiners whose earnings follow energy supply."),
    ("energy_chokepoint", (*CONFLICT, "shippingMaritimeDisruption", "terrorismSecurityIncident"), _STRAITS, True, ("XOM", "CVX", "SHEL", "BP", "RELIANCE", "ONGC", "IOC", "BPCL"), "Energy companies exposed to disruption of a major oil shipping route."),
    ("shipping_disruption", ("shippingMaritimeDisruption",), (), False, ("ZIM", "MAERSK-B", "ADANIPORTS", "SCI"), "Container lines and port operators directly affected by shipping disruption."),
    ("chokepoint_shipping", (*CONFLICT, "terrorismSecurityIncident"), ("hormuz", "red sea", "suez", "bab el-mandeb", "bab al-mandab", "gulf of aden", "malacca", "taiwan strait"), True, ("ZIM", "MAERSK-B", "ADANIPORTS", "SCI"), "Shipping and port companies on routes affected by the dispute."),
    ("defense_conflict", ("warArmedConflict", "militaryMovement"), (), False, ("LMT", "RTX", "NOC", "GD", "HAL", "BEL"), "Defence contractors whose orders track armed-conflict activity."),
    ("aviation_disruption", ("aviationDisruption",), (), False, ("DAL", "UAL", "BA", "INDIGO"), "Airlines and aircraft makers affected by aviation disruption."),
    ("financial_system", ("bankingFinancialSystem", "centralBankDecision"), (), False, ("JPM", "GS", "HDFCBANK", "SBIN"), "Large banks directly affected by financial-system or interest-rate developments."),
    ("taiwan_semiconductors", CONFLICT, ("taiwan",), True, ("TSM", "NVDA", "INTC"), "Chip makers dependent on Taiwan-based semiconductor manufacturing."),
)
COMPANY_LIMIT, COMPANY_LIMIT_IMPACT, COMPANY_LIMIT_WATCH, SEARCH_LIMIT = 12, 4, 50, 20
