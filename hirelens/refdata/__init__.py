"""Reference vocabularies and lookup tables.

Everything under a "Fixed values" comment must stay equal to the studied
pipeline's vocabularies for results to match; it is stated as plain text in
its natural order.  Tables we added ourselves (synthetic rates, name→ISO
codes, country currencies, cluster signatures) are marked as our own.

These lists are small and bounded (the largest has ~160 tokens), so they are
compiled into literal regexes / literal maps on the driver, or turned into
tiny DataFrames that are broadcast with a known size.
"""

from __future__ import annotations

import json
from pathlib import Path

_HERE = Path(__file__).resolve().parent

# ---------------------------------------------------------------------------
# Skill keyword lists, in the order they are declared upstream.
# ---------------------------------------------------------------------------
KEYWORDS_PROGRAMMING = [
    "sql", "python", "r", "c", "c#", "javascript", "js", "java", "scala", "sas", "matlab",
    "c++", "c/c++", "perl", "go", "typescript", "bash", "html", "css", "php", "powershell", "rust",
    "kotlin", "ruby", "dart", "assembly", "swift", "vba", "lua", "groovy", "delphi", "objective-c",
    "haskell", "elixir", "julia", "clojure", "solidity", "lisp", "f#", "fortran", "erlang", "apl",
    "cobol", "ocaml", "crystal", "javascript/typescript", "golang", "nosql", "mongodb", "t-sql", "no-sql",
    "visual_basic", "pascal", "mongo", "pl/sql", "sass", "vb.net", "mssql",
]
KEYWORDS_LIBRARIES = [
    "scikit-learn", "jupyter", "theano", "opencv", "spark", "nltk", "mlpack", "chainer", "fann", "shogun",
    "dlib", "mxnet", "node.js", "vue", "vue.js", "keras", "ember.js", "jse/jee",
]
KEYWORDS_ANALYST_TOOLS = [
    "excel", "tableau", "word", "powerpoint", "looker", "powerbi", "outlook", "azure", "jira", "twilio",
    "snowflake", "shell", "linux", "sas", "sharepoint", "mysql", "visio", "git", "mssql", "powerpoints",
    "postgresql", "spreadsheets", "seaborn", "pandas", "gdpr", "spreadsheet", "alteryx", "github", "postgres",
    "ssis", "numpy", "power_bi", "spss", "ssrs", "microstrategy", "cognos", "dax", "matplotlib", "dplyr",
    "tidyr", "ggplot2", "plotly", "esquisse", "rshiny", "mlr", "docker", "hadoop", "airflow", "redis",
    "graphql", "sap", "tensorflow", "node", "asp.net", "unix", "jquery", "pyspark", "pytorch", "gitlab",
    "selenium", "splunk", "bitbucket", "qlik", "terminal", "atlassian", "unix/linux", "linux/unix", "ubuntu",
    "nuix", "datarobot",
]
KEYWORDS_CLOUD = ["aws", "azure", "gcp", "snowflake", "redshift", "bigquery", "aurora"]

# Fixed value: canonical name for the Power BI spellings.
POWER_BI = "Power BI"

# Our addition (see SURVEY Q18): "power bi" written with a space is a keyword too.
EXTRA_ANALYST_TOOLS = ["power bi"]

SKILL_CATEGORIES = {
    "programming_languages": KEYWORDS_PROGRAMMING,
    "libraries": KEYWORDS_LIBRARIES,
    "analyst_tools": KEYWORDS_ANALYST_TOOLS + EXTRA_ANALYST_TOOLS,
    "cloud_platforms": KEYWORDS_CLOUD,
}
SKILL_COLUMNS = list(SKILL_CATEGORIES)


def canonical_skill(keyword: str) -> str:
    """Canonical spelling: Power BI variants collapse, everything else is trimmed."""
    squeezed = keyword.strip().lower().replace("-", "").replace(" ", "").replace("_", "")
    return POWER_BI if squeezed == "powerbi" else keyword.strip()


# ---------------------------------------------------------------------------
# Experience / work type / employment type rules.
# ---------------------------------------------------------------------------
SENIOR_TITLE_WORDS = ["senior", "sr", "lead", "principal", "manager", "staff", "head of"]
ASSOCIATE_TITLE_WORD = "associate"
MID_TITLE_WORDS = ["mid-level", "intermediate", "specialist"]
ENTRY_TITLE_WORDS = ["junior", "jr", "entry-level", "graduate", "intern", "trainee"]
ENTRY_DESCRIPTION_PHRASES = ["recent graduate", "entry-level role", "fresh graduate"]

EXPERIENCE_LEVELS = ["Entry-Level", "Mid-Level", "Senior", "Not Specified"]
NOT_SPECIFIED = "Not Specified"

# (label, substrings checked first, word-boundary regex alternatives checked second)
WORK_TYPE_RULES = [
    ("Remote", ["remote"], None),
    ("Hybrid", ["hybrid"], None),
    ("On-site", ["on-site", "on site", "office-based"], None),
    ("Remote", None, ["remote", "work from home", "wfh"]),
    ("Hybrid", None, ["hybrid", "flexible location", "partially remote"]),
    ("On-site", None, ["on[- ]?site", "on site", "office-based"]),
]
EMPLOYMENT_TYPE_RULES = [
    ("Full-time", ["full-time", "full time", "permanent"], None),
    ("Part-time", ["part-time", "part time"], None),
    ("Contract", ["contract", "contractor"], None),
    ("Temporary", ["temporary", "temp"], None),
    ("Internship", ["internship", "intern"], None),
    ("Freelance", ["freelance", "freelancer"], None),
    ("Full-time", None, ["full[- ]?time", "permanent"]),
    ("Part-time", None, ["part[- ]?time"]),
    ("Contract", None, ["contract", "contractor"]),
    ("Temporary", None, ["temporary", "temp"]),
    ("Internship", None, ["internship", "intern"]),
    ("Freelance", None, ["freelance", "freelancer"]),
]

# ---------------------------------------------------------------------------
# Salary vocabulary.
# Currency symbols, codes and names as declared upstream (duplicates kept as
# written; the pattern builder de-duplicates and sorts longest first).
# ---------------------------------------------------------------------------
CURRENCY_TOKENS = [
    "MX$",
    "$", "£", "€", "¥", "₹", "₽", "₩", "₪", "₦", "₡", "₴", "₨", "₵", "₫", "₮", "₯", "₰", "₱", "₲", "₳", "₴", "₵",
    "₶", "₷", "₸", "₹", "₺", "₻", "₼", "₽", "₾", "₿", "＄", "￠", "￡", "￢", "￣", "￤", "￥", "￦",
    "USD", "EUR", "GBP", "JPY", "CNY", "INR", "CAD", "AUD", "CHF", "SEK", "NOK", "DKK", "RUB", "KRW", "SGD",
    "HKD", "NZD", "MXN", "BRL", "ZAR", "THB", "MYR", "IDR", "PHP", "VND", "TWD", "PLN", "CZK", "HUF", "TRY",
    "ILS", "AED", "SAR", "EGP", "QAR", "KWD", "BHD", "OMR", "JOD", "LBP", "PKR", "LKR", "BDT", "NPR", "AFN",
    "MMK", "LAK", "KHR", "BND", "FJD", "PGK", "SBD", "TOP", "VUV", "WST",
    "RM", "MYR", "RINGGIT", "MALAYSIAN RINGGIT",
    "SGD", "SINGAPORE DOLLAR", "S$",
    "RUPIAH", "IDR", "RP",
    "BAHT", "THB", "฿",
    "PESO", "PESOS", "PHP", "₱",
    "DONG", "VND", "₫",
    "RUPEE", "RUPEES", "INR", "RS", "₹",
    "YUAN", "RENMINBI", "CNY", "RMB", "¥",
    "WON", "KRW", "₩",
    "DIRHAM", "AED", "DH",
    "RIYAL", "SAR", "SR",
    "SHEKEL", "ILS", "₪",
    "LIRA", "TRY", "₺",
    "RUBLE", "ROUBLE", "RUB", "₽",
    "RAND", "ZAR", "R",
    "REAL", "BRL", "R$",
    "KRONA", "KRONOR", "SEK", "KR",
    "KRONE", "KRONER", "NOK", "DKK",
    "FRANC", "CHF", "FR",
    "ZLOTY", "PLN", "ZŁ",
    "FORINT", "HUF", "FT",
    "KORUNA", "CZK", "KČ",
    "DINAR", "KWD", "BHD", "JOD", "DZD", "IQD", "LYD", "TND",
    "NAIRA", "NGN", "₦",
    "CEDI", "GHS", "₵",
    "BIRR", "ETB",
    "SHILLING", "KES", "UGX", "TZS",
    "AFGHANI", "AFN", "؋",
    "TAKA", "BDT", "৳",
    "KYAT", "MMK", "K",
    "KIP", "LAK", "₭",
    "RIEL", "KHR", "៛",
]

# Our addition: prefixed dollar forms that the normalisation map below knows
# ("US$", "C$", "A$") but the token list above lacks; without them "US$90,000"
# is read as "$90,000" with a stray "US", which breaks "US$1 - US$2" ranges.
EXTRA_CURRENCY_TOKENS = ["US$", "C$", "A$"]

# Our choice: tokens of the list above that are words of English prose; they only count in capitals.
WORD_LIKE_CURRENCIES = ["TOP", "TRY", "WON", "REAL", "FT", "SR", "RAND"]

# Salary period phrases.
PERIOD_PHRASES = [
    "per year", "annually", "yearly", "per annum", "p.a.", "pa",
    "per month", "monthly", "per mth", "p.m.", "pm",
    "per hour", "hourly", "per hr", "p.h.", "ph",
    "per week", "weekly", "per wk", "p.w.", "pw",
    "per day", "daily", "per diem",
]
# Sentence keywords that make a sentence a salary candidate ...
SALARY_KEYWORDS = [
    "salary", "compensation", "pay", "base pay", "base salary", "annual", "per year", "per annum",
    "yearly", "monthly", "per month", "hourly", "per hour", "per week", "per day", "per diem",
    "remuneration", "wage", "package", "rate", "earn", "income",
]
# ... and the funding keywords that disqualify it.
FUNDING_KEYWORDS = [
    "funding", "raised", "investment", "series a", "series b", "series c", "venture", "capital",
    "backed", "round", "financing", "investor", "acrew", "sequoia", "bain", "homebrew", "visa", "million", "billion",
]
# Fixed value: words that introduce a salary range without a currency.
SALARY_LEAD_WORDS = ["salary", "compensation", "pay", "wage", "income"]

# Plausibility bounds and period multipliers.
MIN_ANNUAL_LOCAL = 5000.0
MAX_ANNUAL_USD = 1_000_000.0
PERIOD_MULTIPLIER = {"year": 1, "month": 12, "hour": 40 * 52, "week": 52, "day": 260}

# Symbol / code → ISO mapping used when normalising a currency token.
CURRENCY_TO_ISO = {
    "MX$": "MXN", "MXN": "MXN", "$": "USD", "USD": "USD", "US$": "USD",
    "€": "EUR", "EUR": "EUR", "£": "GBP", "GBP": "GBP", "¥": "JPY", "JPY": "JPY",
    "C$": "CAD", "CAD": "CAD", "A$": "AUD", "AUD": "AUD",
    "MYR": "MYR", "RM": "MYR", "SGD": "SGD", "S$": "SGD",
    "IDR": "IDR", "RP": "IDR", "₱": "PHP", "PHP": "PHP",
    "VND": "VND", "₫": "VND", "INR": "INR", "₹": "INR",
    "CNY": "CNY", "RMB": "CNY", "KRW": "KRW", "₩": "KRW",
    "BRL": "BRL", "R$": "BRL", "ZAR": "ZAR", "R": "ZAR",
    "THB": "THB", "฿": "THB", "PLN": "PLN", "CZK": "CZK", "HUF": "HUF",
    "TRY": "TRY", "₺": "TRY", "ILS": "ILS", "₪": "ILS",
}
# Extra lower-case spellings accepted by the standardisation step.
CURRENCY_ALIASES_LOWER = {
    "rs": "INR", "mx": "MXN", "mx pesos": "MXN", "mexican peso": "MXN", "mexican pesos": "MXN", "top": "TOP",
}

# Our own table: currency names (grouped next to their code in the token list) → ISO code.
CURRENCY_NAME_TO_ISO = {
    "RINGGIT": "MYR", "MALAYSIAN RINGGIT": "MYR", "SINGAPORE DOLLAR": "SGD", "RUPIAH": "IDR",
    "BAHT": "THB", "PESO": "PHP", "PESOS": "PHP", "DONG": "VND", "RUPEE": "INR", "RUPEES": "INR",
    "YUAN": "CNY", "RENMINBI": "CNY", "WON": "KRW", "DIRHAM": "AED", "DH": "AED", "RIYAL": "SAR",
    "SR": "SAR", "SHEKEL": "ILS", "LIRA": "TRY", "RUBLE": "RUB", "ROUBLE": "RUB", "₽": "RUB",
    "RAND": "ZAR", "REAL": "BRL", "KRONA": "SEK", "KRONOR": "SEK", "KR": "SEK", "KRONE": "NOK",
    "KRONER": "NOK", "FRANC": "CHF", "FR": "CHF", "ZLOTY": "PLN", "ZŁ": "PLN", "FORINT": "HUF",
    "FT": "HUF", "KORUNA": "CZK", "KČ": "CZK", "NAIRA": "NGN", "₦": "NGN", "CEDI": "GHS", "₵": "GHS",
    "BIRR": "ETB", "AFGHANI": "AFN", "؋": "AFN", "TAKA": "BDT", "৳": "BDT", "KYAT": "MMK", "K": "MMK",
    "KIP": "LAK", "₭": "LAK", "RIEL": "KHR", "៛": "KHR", "＄": "USD", "￡": "GBP", "￥": "JPY", "₨": "PKR",
    "₴": "UAH", "₸": "KZT", "₾": "GEL", "₼": "AZN", "₲": "PYG", "₡": "CRC", "₮": "MNT", "₿": "BTC",
}

# ---------------------------------------------------------------------------
# Location rules.
# ---------------------------------------------------------------------------
US_STATE_CODES = [
    "al", "ak", "az", "ar", "ca", "co", "ct", "de", "fl", "ga", "hi", "id", "il", "in", "ia", "ks", "ky", "la",
    "me", "md", "ma", "mi", "mn", "ms", "mo", "mt", "ne", "nv", "nh", "nj", "nm", "ny", "nc", "nd", "oh", "ok",
    "or", "pa", "ri", "sc", "sd", "tn", "tx", "ut", "vt", "va", "wa", "wv", "wi", "wy", "dc",
]
LOCATION_NOISE_WORDS = ["metropolitan area", "metroplex", "metro", "region", "area", "county", "greater"]
UNKNOWN_COUNTRY = "Unknown"

# City / region key → country, in declaration order.
CITY_TO_COUNTRY = [
    ("new york", "United States"), ("san francisco", "United States"), ("san francisco bay", "United States"),
    ("bay area", "United States"), ("washington dc", "United States"), ("washington dc-baltimore", "United States"),
    ("dallas-fort worth", "United States"), ("utica-rome", "United States"), ("columbus, ohio", "United States"),
    ("austin, texas", "United States"), ("greater chicago", "United States"), ("greater st. louis", "United States"),
    ("greater tampa bay", "United States"), ("greater minneapolis-st. paul", "United States"),
    ("salt lake", "United States"), ("charlotte", "United States"), ("kansas", "United States"),
    ("des moines", "United States"), ("greater paris", "France"), ("paris", "France"), ("porto", "Portugal"),
    ("lisbon", "Portugal"), ("mumbai", "India"), ("greater kolkata", "India"), ("bangkok", "Thailand"),
    ("jakarta", "Indonesia"), ("bengaluru", "India"), ("greater bengaluru", "India"), ("greater istanbul", "Turkey"),
    ("greater coventry", "United Kingdom"), ("hongkou", "China"), ("kuala lumpur", "Malaysia"),
    ("mexico city", "Mexico"), ("mexico", "Mexico"), ("rio de janeiro", "Brazil"),
    ("greater rio de janeiro", "Brazil"), ("campinas", "Brazil"), ("brazil", "Brazil"), ("calgary", "Canada"),
    ("canada", "Canada"), ("istanbul", "Turkey"), ("chicago", "United States"), ("st. louis", "United States"),
    ("tampa", "United States"), ("rome", "Italy"), ("coventry", "United Kingdom"), ("kolkata", "India"),
    ("utah", "United States"), ("dallas", "United States"), ("fort worth", "United States"),
    ("baltimore", "United States"), ("minneapolis", "United States"), ("st. paul", "United States"),
    ("nasr", "Egypt"),
    ("los angeles", "United States"), ("boston", "United States"), ("seattle", "United States"),
    ("toronto", "Canada"), ("vancouver", "Canada"), ("delhi", "India"), ("beijing", "China"),
    ("shanghai", "China"), ("são paulo", "Brazil"), ("madrid", "Spain"), ("barcelona", "Spain"),
    ("berlin", "Germany"), ("munich", "Germany"), ("london", "United Kingdom"), ("manchester", "United Kingdom"),
    ("sydney", "Australia"), ("melbourne", "Australia"),
]

# Our own table: country → (ISO currency, alternative names).  It stands in for
# the country-name libraries and online lookups (not built).  All other
# countries and their currencies come from the JVM's locale data
# (``functions.places``); this table has the names and spellings we want kept.
COUNTRY_INFO = [
    ("United States", "USD", ["usa", "us", "united states of america", "america"]),
    ("United Kingdom", "GBP", ["uk", "great britain", "england", "scotland", "wales"]),
    ("France", "EUR", []), ("Portugal", "EUR", []), ("Spain", "EUR", []), ("Germany", "EUR", []),
    ("Italy", "EUR", []), ("Netherlands", "EUR", ["holland"]), ("Ireland", "EUR", []), ("Belgium", "EUR", []),
    ("Austria", "EUR", []), ("Finland", "EUR", []), ("Greece", "EUR", []),
    ("India", "INR", []), ("Thailand", "THB", []), ("Indonesia", "IDR", []), ("Malaysia", "MYR", []),
    ("Singapore", "SGD", []), ("Philippines", "PHP", []), ("Vietnam", "VND", ["viet nam"]),
    ("China", "CNY", []), ("Japan", "JPY", []), ("South Korea", "KRW", ["korea"]),
    ("Pakistan", "PKR", []), ("Bangladesh", "BDT", []), ("Sri Lanka", "LKR", []),
    ("Mexico", "MXN", []), ("Brazil", "BRL", []), ("Canada", "CAD", []), ("Australia", "AUD", []),
    ("New Zealand", "NZD", []), ("Turkey", "TRY", ["turkiye", "türkiye"]), ("Egypt", "EGP", []),
    ("United Arab Emirates", "AED", ["uae"]), ("Saudi Arabia", "SAR", ["ksa"]), ("Qatar", "QAR", []),
    ("Israel", "ILS", []), ("South Africa", "ZAR", []), ("Nigeria", "NGN", []), ("Kenya", "KES", []),
    ("Switzerland", "CHF", []), ("Sweden", "SEK", []), ("Norway", "NOK", []), ("Denmark", "DKK", []),
    ("Poland", "PLN", []), ("Czechia", "CZK", ["czech republic"]), ("Hungary", "HUF", []),
    ("Russia", "RUB", ["russian federation"]), ("Argentina", "ARS", []), ("Chile", "CLP", []),
    ("Colombia", "COP", []), ("Peru", "PEN", []),
]

# Our own tables: states and provinces (name, code or None) by country.
STATES = {
    "United States": [
        ("alabama", "al"), ("alaska", "ak"), ("arizona", "az"), ("arkansas", "ar"), ("california", "ca"), ("colorado", "co"),
        ("connecticut", "ct"), ("delaware", "de"), ("florida", "fl"), ("georgia", "ga"), ("hawaii", "hi"), ("idaho", "id"),
        ("illinois", "il"), ("indiana", "in"), ("iowa", "ia"), ("kansas", "ks"), ("kentucky", "ky"), ("louisiana", "la"), ("maine", "me"),
        ("maryland", "md"), ("massachusetts", "ma"), ("michigan", "mi"), ("minnesota", "mn"), ("mississippi", "ms"), ("missouri", "mo"),
        ("montana", "mt"), ("nebraska", "ne"), ("nevada", "nv"), ("new hampshire", "nh"), ("new jersey", "nj"), ("new mexico", "nm"),
        ("new york", "ny"), ("north carolina", "nc"), ("north dakota", "nd"), ("ohio", "oh"), ("oklahoma", "ok"), ("oregon", "or"),
        ("pennsylvania", "pa"), ("rhode island", "ri"), ("south carolina", "sc"), ("south dakota", "sd"), ("tennessee", "tn"),
        ("texas", "tx"), ("utah", "ut"), ("vermont", "vt"), ("virginia", "va"), ("washington", "wa"), ("west virginia", "wv"),
        ("wisconsin", "wi"), ("wyoming", "wy"), ("district of columbia", "dc"), ("puerto rico", "pr"),
    ],
    "Canada": [
        ("ontario", "on"), ("quebec", "qc"), ("québec", None), ("british columbia", "bc"), ("alberta", "ab"), ("manitoba", "mb"),
        ("saskatchewan", "sk"), ("nova scotia", "ns"), ("new brunswick", "nb"), ("newfoundland and labrador", "nl"),
        ("prince edward island", "pe"), ("yukon", "yt"), ("nunavut", "nu"),
    ],
    "Australia": [
        ("new south wales", "nsw"), ("victoria", "vic"), ("queensland", "qld"), ("western australia", "wa"), ("south australia", "sa"),
        ("tasmania", "tas"), ("australian capital territory", "act"), ("northern territory", "nt"),
    ],
    "United Kingdom": [("england", None), ("scotland", None), ("wales", None), ("northern ireland", None)],
    "India": [(x, None) for x in (
        "andhra pradesh", "assam", "bihar", "goa", "gujarat", "haryana", "jharkhand", "karnataka", "kerala", "madhya pradesh",
        "maharashtra", "odisha", "punjab", "rajasthan", "tamil nadu", "telangana", "uttar pradesh", "uttarakhand", "west bengal")],
    "Germany": [(x, None) for x in (
        "bavaria", "bayern", "baden württemberg", "brandenburg", "hesse", "hessen", "lower saxony", "niedersachsen",
        "north rhine westphalia", "nordrhein westfalen", "rhineland palatinate", "saarland", "saxony", "sachsen", "thuringia")],
    "Pakistan": [("sindh", None), ("punjab", None)],
    "Brazil": [("minas gerais", None), ("paraná", None), ("rio grande do sul", None)],
    "Spain": [("catalonia", None), ("andalusia", None), ("community of madrid", None)],
    "France": [("île de france", None), ("provence alpes côte d azur", None)],
    "Italy": [("lombardy", None), ("lazio", None), ("tuscany", None)],
}
# Our own table: cities beyond the fixed keys, the likeliest country first where several have one of the name.
MORE_CITIES = {
    "United States": [
        "houston", "phoenix", "philadelphia", "san antonio", "san diego", "san jose", "austin", "jacksonville", "columbus", "indianapolis",
        "denver", "washington dc", "nashville", "oklahoma city", "el paso", "portland", "las vegas", "detroit", "memphis", "louisville",
        "milwaukee", "albuquerque", "tucson", "fresno", "sacramento", "kansas city", "atlanta", "miami", "raleigh", "omaha", "oakland",
        "cleveland", "pittsburgh", "cincinnati", "orlando", "silicon valley", "palo alto", "boulder", "brooklyn"],
    "United Kingdom": ["birmingham", "leeds", "glasgow", "edinburgh", "liverpool", "bristol", "cardiff", "belfast", "cambridge", "oxford", "london", "manchester"],
    "Canada": ["montreal", "montréal", "ottawa", "edmonton", "winnipeg", "vancouver", "toronto", "waterloo"],
    "Germany": ["hamburg", "frankfurt", "cologne", "köln", "stuttgart", "düsseldorf", "leipzig", "münchen", "nuremberg"],
    "France": ["lyon", "marseille", "toulouse", "nantes", "bordeaux", "lille", "grenoble"],
    "Spain": ["valencia", "seville", "málaga", "bilbao"],
    "Italy": ["milan", "milano", "turin", "naples", "bologna", "florence"],
    "Netherlands": ["amsterdam", "rotterdam", "the hague", "utrecht", "eindhoven"],
    "Belgium": ["brussels", "antwerp", "ghent"], "Switzerland": ["zurich", "zürich", "geneva", "basel", "bern", "lausanne"],
    "Austria": ["vienna", "graz"], "Ireland": ["dublin", "cork", "galway"], "Portugal": ["braga"], "Greece": ["athens", "thessaloniki"],
    "Poland": ["warsaw", "krakow", "kraków", "wrocław", "gdańsk"], "Czechia": ["prague", "brno"], "Hungary": ["budapest"],
    "Romania": ["bucharest", "cluj napoca", "iași"], "Bulgaria": ["sofia"], "Serbia": ["belgrade"], "Croatia": ["zagreb"],
    "Ukraine": ["kyiv", "kiev", "lviv"], "Russia": ["moscow", "saint petersburg"], "Turkey": ["ankara", "izmir"],
    "Sweden": ["stockholm", "gothenburg", "malmö"], "Norway": ["oslo", "bergen"], "Denmark": ["copenhagen", "aarhus"], "Finland": ["helsinki", "espoo"],
    "Estonia": ["tallinn"], "Latvia": ["riga"], "Lithuania": ["vilnius"], "Georgia": ["tbilisi"], "Armenia": ["yerevan"],
    "India": ["bangalore", "hyderabad", "chennai", "pune", "ahmedabad", "noida", "gurgaon", "gurugram", "jaipur", "kochi"],
    "Pakistan": ["karachi", "lahore", "islamabad"], "Bangladesh": ["dhaka"], "Sri Lanka": ["colombo"], "Nepal": ["kathmandu"],
    "China": ["shenzhen", "guangzhou", "hangzhou", "chengdu", "nanjing"], "Hong Kong": ["kowloon"], "Taiwan": ["taipei", "hsinchu"],
    "Japan": ["tokyo", "osaka", "kyoto", "yokohama"], "South Korea": ["seoul", "busan"], "Vietnam": ["hanoi", "ho chi minh city"],
    "Philippines": ["manila", "makati", "cebu", "quezon city"], "Indonesia": ["bandung", "surabaya"], "Malaysia": ["penang", "selangor"],
    "Australia": ["brisbane", "perth", "adelaide", "canberra"], "New Zealand": ["auckland", "wellington", "christchurch"],
    "Brazil": ["brasília", "belo horizonte", "curitiba", "porto alegre"], "Mexico": ["guadalajara", "monterrey"], "Argentina": ["buenos aires"],
    "Chile": ["santiago"], "Colombia": ["bogotá", "bogota", "medellín"], "Peru": ["lima"], "Costa Rica": ["san josé"],
    "Egypt": ["cairo", "alexandria"], "Nigeria": ["lagos", "abuja"], "Kenya": ["nairobi"], "South Africa": ["johannesburg", "cape town", "durban"],
    "Morocco": ["casablanca"], "Ghana": ["accra"], "Israel": ["tel aviv", "jerusalem", "haifa"], "Saudi Arabia": ["riyadh", "jeddah"],
    "United Arab Emirates": ["dubai", "abu dhabi"], "Qatar": ["doha"], "Kuwait": ["kuwait city"],
}
# Cities that a second country has as well; the neighbouring parts decide.
ALSO_IN = {
    "london": "Canada", "vancouver": "United States", "manchester": "United States", "birmingham": "United States", "cambridge": "United States",
    "paris": "United States", "dublin": "United States", "athens": "United States", "rome": "United States", "naples": "United States",
    "melbourne": "United States", "moscow": "United States", "san jose": "Costa Rica", "valencia": "Venezuela", "portland": "Australia",
    "perth": "United Kingdom", "lima": "United States", "santiago": "Spain", "waterloo": "Belgium", "hyderabad": "Pakistan", "bergen": "United States",
}

# ---------------------------------------------------------------------------
# Cluster names by id, and the signature skills documented for
# each cluster (used to name clusters from their centres, SURVEY Q11).
# ---------------------------------------------------------------------------
CLUSTER_NAMES = [
    "Business / Reporting Analysts",
    "Machine Learning Engineers / Researchers",
    "General Data Scientists / Analytics Engineers",
    "Data Engineers / Big-Data Specialists",
    "BI / Analytics Developers",
]
CLUSTER_SIGNATURES = {
    "Business / Reporting Analysts": ["excel", "sql", "tableau", "powerpoint", "word"],
    "Machine Learning Engineers / Researchers": ["python", "tensorflow", "pytorch", "scikit-learn"],
    "General Data Scientists / Analytics Engineers": ["sql", "python", "r"],
    "Data Engineers / Big-Data Specialists": ["azure", "python", "sql", "spark", "aws", "snowflake"],
    "BI / Analytics Developers": ["tableau", "sql", "python", "r", "looker"],
}
N_CLUSTERS = 5
CLUSTER_SEED = 42
TOP_SKILL_FEATURES = 50

# Bronze merge: candidate key columns, in order of preference (fixed values).
MERGE_KEY_CANDIDATES = ["link", "job_url", "Job URL", "Job Url", "JobURL"]


def synthetic_rates() -> dict[str, float]:
    """Synthetic units-per-USD rates shipped with the package (not market data)."""
    with open(_HERE / "rates_usd.json", encoding="utf-8") as fh:
        return json.load(fh)

