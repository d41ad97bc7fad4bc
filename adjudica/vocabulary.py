"""Alias maps, word lists and patterns that results depend on.

Everything here is a default. Each function that uses one takes it as a parameter, so a caller can
bring another vocabulary.
"""

from __future__ import annotations

# --- fixed values: party names -------------------------------------------------------------------
PARTY_ALIASES = {
    "apex chemicals": "apex_chemicals",
    "apex chem": "apex_chemicals",
    "apex": "apex_chemicals",
    "orion pharma": "orion_pharma",
    "orion pharmaceuticals": "orion_pharma",
    "orion": "orion_pharma",
    "shakti cement": "shakti_cement",
    "shakthi cement": "shakti_cement",
    "shakti": "shakti_cement",
    "vertex retail": "vertex_retail",
    "vertex": "vertex_retail",
    "internal": "internal",
}
COMPANY_SUFFIXES = r"\b(private limited|pvt\.? ?ltd\.?|pvt\.?|limited|ltd\.?|llp|inc\.?|corp\.?|co\.?)\b"

# --- fixed values: places ------------------------------------------------------------------------
PLACE_ALIASES = {
    "ambala": "ambala",
    "chandigarh": "chandigarh",
    "delhi": "delhi",
    "new delhi": "delhi",
    "gurgaon": "gurgaon",
    "gurugram": "gurgaon",
    "jaipur": "jaipur",
    "kanpur": "kanpur",
    "lucknow": "lucknow",
    "ludhiana": "ludhiana",
    "rudrapur": "rudrapur",
    "faridabad": "faridabad",
    "noida": "noida",
    "nainital": "nainital",
    "haldwani": "haldwani",
}
PLACE_NOISE = r"\b(wh|warehouse|hub|depot|dc|plant|yard|terminal|centre|center|branch)\b"
RESTRICTED_PLACES = ["delhi", "gurgaon", "faridabad", "noida"]
HILL_PLACES = ["rudrapur", "nainital", "haldwani"]
EASTERN_PLACES = ["gorakhpur", "varanasi", "patna", "gonda", "basti"]

# --- fixed values: component classes, first match wins --------------------------------------------
COMPONENT_CLASSES = [
    ("brake", r"\bbrake|braking"),
    ("suspension", r"wheel bearing|leaf spring|shocker|suspension"),
    ("steering", r"steering"),
    ("gearbox", r"gear ?box|clutch|transmission|differential"),
    ("tyre", r"\bty?res?\b|\btires?\b|puncture|burst"),
    ("radiator", r"radiator|coolant|cooling"),
    ("turbo", r"turbo"),
    ("fuel", r"fuel|diesel|injector|def pump"),
    ("electrical", r"battery|alternator|starter|wiring|electrical|\bfuse\b|headlight"),
    ("ac", r"\bac\b|compressor"),
    ("engine", r"fan belt|air filter|oil seal|head gasket|piston|\bengine\b|seize"),
]
SYMPTOM_CLASSES = [("engine", r"overheat|garam")]

# --- fixed values: small enumerations -------------------------------------------------------------
TRUE_WORDS = ["yes", "y", "true", "1", "haan"]
FALSE_WORDS = ["no", "n", "false", "0", "nahi"]
SEVERITIES = ["LOW", "MEDIUM", "HIGH"]

# --- fixed values: history predicates and windows ---------------------------------------------------
BRAKE_NOTE = r"brake|braking"
TEMP_FIX_NOTE = r"jugaad"
PENDING_FIX_NOTE = (
    r"permanent fix baaki|permanent repair pending|needs permanent repair|permanent fix pending"
)
SERVICE_INTERVAL_DAYS = 90
TEMP_FIX_WINDOW_DAYS = 7
NO_SUCH_EVENT_DAYS = 99999
NIGHT_FROM_HOUR = 20
NIGHT_TO_HOUR = 6
DAYS_PER_MONTH = 30.4375

# --- fixed values: queue fields and their aliases (canonical spelling of each alias) -----------------
QUEUE_FIELD_ALIASES = {
    "ticket_id": ["ticketid", "id", "ticketno", "ticketnumber", "ref", "reference", "caseid"],
    "created_at": ["createdat", "opened", "openedat", "reportedat", "reported", "timestamp", "datetime", "date", "raisedat"],
    "vehicle": ["vehicle", "vehiclereg", "vehicleno", "vehiclenumber", "registration", "registrationnumber", "reg", "truck", "truckno", "plate"],
    "driver_id": ["driverid", "driver", "drivercode", "driverno"],
    "origin_hub": ["originhub", "origin", "fromhub", "from", "sourcehub", "starthub", "depot"],
    "destination": ["destination", "dest", "desthub", "destinationhub", "tohub", "to"],
    "km_from_origin_hub": ["kmfromoriginhub", "kmfromorigin", "distancekm", "km", "distance", "kms"],
    "issue": ["issue", "fault", "problem", "description", "issuedescription", "complaint", "breakdowntype"],
    "severity": ["severity", "priority", "sev", "urgency"],
    "client": ["client", "customer", "clientname", "customername", "account"],
    "status": ["status", "state"],
    "resolution_note": ["resolutionnote", "resolution", "note", "notes", "remarks", "comment"],
}
WRAPPER_KEYS = ["tickets", "records", "data", "items", "rows", "queue", "results"]
MIN_RECOGNISED_FIELDS = 3

# --- fixed values: question answering ----------------------------------------------------------------
INTENTS = [
    ("location", r"\b(where|current location|right now|currently|position|gps|located|live location)\b"),
    ("maintenance", r"\b(maintenance|service|serviced|repair|repaired|brake|jugaad|odometer|workshop|mechanic|overdue|due)\b"),
    ("vehicle_spec", r"\b(year|model|bs4|bs6|bs stage|heater|capacity|tonnes|hub|home hub|registration|fleet|old|new)\b"),
    ("client_rule", r"\b(sla|delivery window|hours|deadline|gate|warehouse|closes|rotate|rotation|overnight|pharma|newest|penalty|failed delivery)\b"),
    ("rule", r"\b(rule|policy|allowed|permitted|must|never|always|restriction|grap|winter|monsoon|night)\b"),
    ("driver", r"\b(driver|tenure|joined|joining|roster|solo|night run)\b"),
    ("trip", r"\b(trip|trips|dispatch|route|history|delivered)\b"),
]
PARTY_WORDS = ["shakti", "vertex", "apex", "orion", "internal"]
PLACE_WORDS = [
    "ambala", "chandigarh", "delhi", "gurgaon", "gurugram", "jaipur", "kanpur",
    "lucknow", "ludhiana", "rudrapur", "faridabad", "noida", "nainital",
]
STOP_WORDS = [
    "what", "which", "when", "where", "who", "why", "how", "is", "are", "was", "were", "the", "a",
    "an", "of", "for", "to", "on", "in", "and", "or", "do", "does", "did", "can", "should", "has",
    "have", "had", "me", "tell", "show", "about", "that", "this",
]
PARTY_RULE_HINTS = {
    "shakti_cement": ["R-SHAKTI-36H"],
    "orion_pharma": ["R-ORION-NEWEST", "R-ORION-NO-OVERNIGHT"],
    "vertex_retail": ["R-VERTEX-GATE-6PM", "R-VERTEX-NOT-FAILED"],
    "apex_chemicals": ["R-APEX-ROTATE"],
}
