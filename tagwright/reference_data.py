"""Small tables that results depend on."""

CURRENCY_OF_COUNTRY = {"UAE": "AED", "KSA": "SAR", "Qatar": "QAR", "Kuwait": "KWD", "Bahrain": "BHD", "Oman": "OMR"}
DECIMALS_OF_CURRENCY = {"AED": 2, "SAR": 2, "QAR": 2, "KWD": 3, "BHD": 3, "OMR": 3}
PRICE_FLOOR = {"AED": 150, "SAR": 150, "QAR": 150, "KWD": 15, "BHD": 15, "OMR": 15}
COUNTRY_ALIASES = {
    "uae": "UAE", "dubai": "UAE", "abudhabi": "UAE",
    "ksa": "KSA", "saudi": "KSA", "sa": "KSA",
    "qatar": "Qatar", "qat": "Qatar", "qtr": "Qatar",
    "kuwait": "Kuwait", "kwt": "Kuwait", "kw": "Kuwait", "kuw": "Kuwait",
    "bahrain": "Bahrain", "bhr": "Bahrain", "bh": "Bahrain", "bah": "Bahrain",
    "oman": "Oman", "omn": "Oman", "om": "Oman", "oma": "Oman",
}
RETAILER_ALIASES = {
    "c4": "Carrefour", "carrefour": "Carrefour", "cf": "Carrefour",
    "lulu": "Lulu",
    "sharaf": "SharafDG", "sharafdg": "SharafDG", "sdg": "SharafDG",
    "emax": "Emax", "emaxme": "Emax",
}
COUNTRY_DISPLAY = {"UAE": "United Arab Emirates", "KSA": "Saudi Arabia"}
RETAILER_DISPLAY = {"SharafDG": "Sharaf DG"}
#: zoom, where prices stand relative to the code
PROFILES = {"Carrefour": (3.0, "above"), "Lulu": (3.0, "above"), "SharafDG": (4.0, "above"), "Emax": (3.0, "below")}
DEFAULT_PROFILE = (3.0, "above")
#: Characters that scanners take for each other, and the one each class is read as.
CONFUSED, READ_AS = "OILSBZG", "0115826"
SHORT_CODE, LEAST_CODE = 5, 3
FUZZY_THRESHOLD, NEAR_TIE = 85, 8
#: What a misread character may become in noise tests.
CODE_CHARACTERS = "ABCDEFGHJKLMNPQRSTUVWXYZ0123456789"
MONTHS = ("jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec")
MONTH = r"(?:Jan(?:uary)?|Feb(?:ruary)?|Mar(?:ch)?|Apr(?:il)?|May|Jun(?:e)?|Jul(?:y)?|Aug(?:ust)?|Sep(?:tember)?|Oct(?:ober)?|Nov(?:ember)?|Dec(?:ember)?)"
RANGE_SEPARATOR = r"\s*(?:-|–|—|to|till|until)\s*"
NAMED_RANGE = rf"(?i)(\d{{1,2}})\s*({MONTH})?\s*{RANGE_SEPARATOR}(\d{{1,2}})\s*({MONTH})\s*,?\s*(\d{{4}})?"
NUMERIC_RANGE = rf"(\d{{1,2}})/(\d{{1,2}})(?:/(\d{{2,4}}))?{RANGE_SEPARATOR}(\d{{1,2}})/(\d{{1,2}})(?:/(\d{{2,4}}))?"
KEYWORDS = r"APPLIANCE|REFRIGERAT|FRIDGE|FREEZER|WASHER|WASHING\s*MACHINE|DRYER|DISHWASH"
KEYWORD_QUORUM = 3
CROSSWALK = {
    "RB50DG632ES9AE": "RB50DG632ES9",
    "RF65DB975E22AE": "RF65DB975E22AE",
    "RF65DG90BEB1AE": "RF65DG90BEB1",
    "RF71DG9H0EB1AE": "RF71DG9H0EB1AE",
    "RS70F65Q1FAE": "RS70F65Q1FAE",
    "RT38CG6404S9AE": "RT50CG6404S9",
    "RT47CB664622AE": "RT66CB664622",
    "RT47CG6406S9AE": "RT66CG6406S9",
    "RT53DG7A14S9AE": "RT75DG7A14S9AE",
    "RT58K7057SL/AE": "RT81K7057SL",
    "RT62K7158SL/AE": "RT85K7158SL",
    "RS90F64D1FAE": "RS90F64D1",
    "RS90F66B1FAE": "RS90F66B1FAE",
    "RS70F64K1TAE": "RS70F64K1T",
}
HEADERS = (
    "Leaflet / File Name", "Retailer", "Country / Region", "Week Number", "Year-Week", "Promo Start Date", "Promo End Date", "Promo Duration (days)",
    "Brand", "Model Number", "Product Category", "Sub-Category", "Capacity / Size", 'Regular Price ("was")', 'Promo Price ("now")',
    "Discount Amount", "Discount %", "Other Offer Details", "Page / Position", "Notes / Flags", "Currency",
)
# Geometry in pixels at zoom 3.
CLUSTER_DX, CLUSTER_DY = 350, 175
TILE_HEIGHT, TIE_DX, COLUMN_GAP = 1200, 60, 300
FINANCING_DX, FINANCING_DY = 300, 45
MEMBER_DX, MEMBER_DY = 250, 35
CLEAR_CONF = 0.80
PRICE_TOKEN = r"^[A-Za-z]{0,3}\s?(\d{1,3}(?:,\d{3})+|\d{3,6})(?:\.(\d{1,3}))?$"
PERCENT_TOKEN = r"^-?\s*\d{1,2}\s*%$"
PERCENT = r"-?\s*(\d{1,2})\s*%"
CAPACITY = r"(?i)((?:\d+/)?\d+(?:\.\d+)?)\s*(KG|L(?:TRS?|ITRES?)?)[I1l]?(?![A-Za-z])"
FINANCING = r"(?i)tabby|tamara|emi|per\s*month|/\s*mo(?:nth)?\b"
MEMBER = r"(?i)^DG\b"
UNIT_WORD = r"(?i)^(LITRES?|LTRS?|LITERS?|KGS?|KILOS?)$"
NET_CHIP = r"(?i)^(NET|GROSS)[-\s]?(\d{2,4})\s*L?$"
GLUED_WAS = r"(?i)^WAS[D]?(\d{3,6})[!*]?$"
GLUED_PAIR = r"^([A-Z]\d{3,6})([A-Z]\d{3,6})$"
FREEBIE = r"(?i)^WORTH"
PACK_SIZE = (
    r"[+=]",
    r"^\d+X\d",
    r"(?i)^\d+(G|KG|ML|CL|L)(?![A-Z0-9])",
    r"(?i)^\d+(G|KG|ML|CL|L)[A-Z]+$",
    r"(?i)\d+(G|KG|ML|CL|L)$",
    r"(.)\1{3}",
    r"\d-\d$",
    r"^\d+\.\d",
    r"(?i)^(TABBY|TAMARA|EMI)",
    r"[:：]",
    r"(?i)\d+W$",
    r"(?i)^WAS\d",
    r"^[A-Z]\d{3,6}[A-Z]\d{3,6}$",
    r"(?i)^WORTH",
    r"(?i)^(NET|GROSS)[-\s]?\d",
)
