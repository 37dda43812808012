"""The vocabularies, formats and labels that results depend on.

Everything here is data, not logic.  Spellings are listed in lower case because
they are looked up after ``lower(trim(x))``.
"""

# --- identifiers: prefix and minimum digit count ------------------------------
CUSTOMER_ID = ("C", 3)
ORDER_ID = ("ORD-", 4)
PRODUCT_ID = ("P", 3)

# --- spellings -> canonical value --------------------------------------------
BOOLEAN_WORDS = {
    True: ["true", "yes", "oui", "1", "active", "verified"],
    False: ["false", "no", "non", "0", "inactive"],
}
COUNTRY_WORDS = {"FRANCE": ["fr", "france", "french republic"]}
ORDER_STATUS_WORDS = {
    "PAID": ["paid", "payée", "payee"],
    "COMPLETED": ["completed", "complete", "terminée", "terminee"],
    "CANCELLED": ["cancelled", "canceled", "annulée", "annulee"],
    "PENDING": ["pending", "en attente"],
}
PAYMENT_WORDS = {
    "CARD": ["credit card", "card", "cb", "carte bancaire"],
    "WIRE": ["bank transfer", "wire", "virement"],
    "PAYPAL": ["paypal"],
}
CATEGORY_WORDS = {
    "High-tech": ["high tech", "hightech"],
    "Electronique": ["electronique"],
    "Informatique": ["informatique"],
}

# --- closed code lists --------------------------------------------------------
DELIVERY_EVENT_TYPES = [
    "ORDER_CREATED",
    "PREPARING",
    "SHIPPED",
    "IN_TRANSIT",
    "OUT_FOR_DELIVERY",
    "DELIVERED",
    "DELIVERY_FAILED",
    "CANCELLED",
]
UNKNOWN_EVENT_TYPE = "UNKNOWN"
IN_DELIVERY_TYPES = ["SHIPPED", "IN_TRANSIT", "OUT_FOR_DELIVERY"]
ORDER_STATUSES = [
    "CREATED",
    "PAID",
    "PENDING",
    "PREPARING",
    "SHIPPED",
    "COMPLETED",
    "DELIVERED",
    "CANCELLED",
    "RETURNED",
    "UNKNOWN",
]
CURRENCIES = ["EUR", "USD", "GBP", "MAD"]
DEFAULT_CURRENCY = "EUR"

# --- patterns -----------------------------------------------------------------
EMAIL_PATTERN = r"^[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}$"
MOBILE_PATTERN = r"^\+33[67][0-9]{8}$"
NATIONAL_MOBILE_PATTERN = r"^0[67][0-9]{8}$"

# --- date and timestamp formats, in the order they are tried -------------------
DATE_FORMATS = ["yyyy-MM-dd", "yyyy/MM/dd", "dd/MM/yyyy"]
CREATED_AT_FORMATS = [
    "yyyy-MM-dd HH:mm:ss",
    "yyyy/MM/dd HH:mm:ss",
    "yyyy-MM-dd'T'HH:mm:ss",
]
REVIEW_TIMESTAMP_FORMAT = "yyyy-MM-dd'T'HH:mm:ss"
EVENT_TIMESTAMP_FORMATS = [
    "yyyy-MM-dd'T'HH:mm:ss",
    "yyyy-MM-dd HH:mm:ss",
    "yyyy/MM/dd HH:mm:ss",
    "dd/MM/yyyy HH:mm:ss",
]

# --- labels shown where nothing matched ----------------------------------------
NO_PRODUCT_NAME = "Produit supprimé"
NO_PRODUCT = "Aucun produit"
UNKNOWN_F = "Inconnue"
UNKNOWN_M = "Inconnu"
NO_CUSTOMER = "Client inconnu"
NO_EVENT = "AUCUN ÉVÉNEMENT"
NO_REASON = "Motif de rejet non renseigné"

# --- decimal shapes ---------------------------------------------------------------
MONEY = "decimal(10,2)"
RATIO = "decimal(5,2)"
RATING = "decimal(3,2)"
# int quantity x MONEY needs at most 20 digits, so no line amount can overflow
LINE_AMOUNT = "decimal(20,2)"
TOTAL_AMOUNT = "decimal(30,2)"
