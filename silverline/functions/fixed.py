"""Rule data: every word list, lookup table, pattern and field list in one place.

Operators take these as parameters; nothing below is hard-wired into them.
"""

# --- Fixed values: they must equal the published rules for results to match. ---

VALID_CURRENCIES = ["USD", "GBP", "EUR"]
DEFAULT_CURRENCY = "USD"
PRODUCT_SOURCES = ["datasheet", "skincarisma", "dermstore", "cosmetics", "skincare_products"]
INGREDIENT_SOURCES = ["skincarisma", "extracted_from_products"]
UNKNOWN_SOURCE = "unknown"
UNKNOWN_BRAND = "Unknown"
GARBAGE_INGREDIENT = "**†"
MAX_BAD_PRICE = 0.01
MAX_BAD_RATING = 0.0

INTEGER_COLUMNS = [
    "ingredients_count", "number_of_reviews",
    "oily_skin_score", "dry_skin_score", "sensitive_skin_score",
    "combination_skin_score", "normal_skin_score", "acne_prone_score",
    "pregnancy_safe", "fungal_acne_safe", "comedogenic_rating",
    "vegan", "cruelty_free", "reef_safe",
    "fragrance_free", "alcohol_free", "paraben_free",
    "sulfate_free", "silicone_free", "oil_free",
]

CLAIM_RULES = {
    "vegan": ["vegan"],
    "cruelty_free": ["cruelty-free", "cruelty free"],
    "reef_safe": ["reef safe", "reef-safe"],
    "fragrance_free": ["fragrance-free", "fragrance free"],
    "alcohol_free": ["alcohol-free", "alcohol free"],
    "paraben_free": ["paraben-free", "paraben free"],
    "sulfate_free": ["sulfate-free", "sulfate free"],
    "silicone_free": ["silicone-free", "silicone free"],
    "oil_free": ["oil-free", "oil free"],
}

# Ordered: the first label contained in the text gives the score.
SCORE_LABELS = {
    "excellent": 5, "very good": 4, "good": 4, "moderate": 3,
    "fair": 2, "poor": 1, "avoid": 0, "caution": 2,
}

# Ordered: the first word contained in the card title decides the column.
SKIN_TYPE_COLUMNS = {
    "oily": "oily_skin_score", "dry": "dry_skin_score",
    "sensitive": "sensitive_skin_score", "combination": "combination_skin_score",
    "normal": "normal_skin_score", "acne": "acne_prone_score",
}

CONCERN_RULES = {
    "acne": ["acne", "blemish", "pimple", "comedogenic"],
    "hyperpigmentation": ["hyperpigmentation", "dark spots", "melasma", "brightening"],
    "dryness": ["dry", "dryness", "hydration", "moisture"],
    "redness": ["redness", "irritation", "calming", "soothing"],
    "anti_aging": ["anti-aging", "wrinkle", "fine lines", "retinol", "peptide"],
    "barrier": ["barrier", "repair", "tewl"],
}

BENEFIT_RULES = {
    "hydrating": ["hydration", "hydrating", "moisture", "humectant"],
    "soothing": ["soothing", "calm", "redness", "anti-inflammatory"],
    "brightening": ["brightening", "dark spots", "vitamin c"],
    "barrier_support": ["barrier", "repair", "ceramide"],
    "oil_control": ["oil control", "mattifies", "matte", "sebum"],
    "sun_protection": ["spf", "uva", "uvb", "zinc oxide"],
    "exfoliating": ["exfoliating", "aha", "bha", "salicylic", "glycolic"],
}

NAME_EDGE_CHARS = " .–—:"
CONCENTRATION_PATTERN = r"~?\s*[0-9]+(?:\.[0-9]+)?(?:\s*-\s*[0-9]+(?:\.[0-9]+)?)?\s*%"
MAX_NAME_LENGTH = 120
BAD_NAME_WORDS = [
    "cool features", "suited for", "free from", "what it is",
    "fun facts", "this product", "shopify", "critical:", "mandatory",
    "you are an assistant", "ingredient_example",
]

# The text the feature rules look into.
FEATURE_TEXT_FIELDS = [
    "product_name", "brand_name", "category", "sub_category",
    "description", "key_actives_text", "product_claims",
    "benefits", "concerns", "free_from", "skin_type_notes",
]
# feature: (score column whose value >= 4 also counts, words)
FEATURE_RULES = {
    "skin_type_oily": ("oily_skin_score", ["oily", "oil-free", "sebum", "matte"]),
    "skin_type_dry": ("dry_skin_score", ["dry skin", "dryness", "hydrating"]),
    "skin_type_sensitive": ("sensitive_skin_score", ["sensitive", "soothing", "calming"]),
    "skin_type_combination": ("combination_skin_score", ["combination skin"]),
    "skin_type_acne_prone": ("acne_prone_score", ["acne-prone", "acne prone"]),
    "concern_acne": (None, ["acne", "blemish", "salicylic", "bha", "non-comedogenic"]),
    "concern_redness": (None, ["redness", "soothing", "calming", "centella"]),
    "concern_hyperpigmentation": (
        None, ["hyperpigmentation", "dark spot", "brightening", "niacinamide", "vitamin c"]),
    "concern_anti_aging": (None, ["anti-aging", "wrinkle", "retinol", "peptide"]),
    "concern_dryness": (None, ["dryness", "hydration", "moisture", "barrier"]),
    "suitable_for_oily": ("oily_skin_score", ["oily", "oil-free", "matte"]),
    "suitable_for_dry": ("dry_skin_score", ["dry skin", "hydrating", "moisturizing"]),
    "suitable_for_sensitive": ("sensitive_skin_score", ["sensitive", "soothing"]),
    "suitable_for_acne": ("acne_prone_score", ["acne-prone", "non-comedogenic"]),
    "suitable_for_hyperpigmentation": (
        None, ["hyperpigmentation", "dark spot", "brightening"]),
    "suitable_for_anti_aging": (None, ["anti-aging", "wrinkle", "retinol", "peptide"]),
    "suitable_for_redness": (None, ["redness", "soothing", "calming"]),
}
AVOID_SENSITIVE_WORDS = ["fragrance", "alcohol denat"]
AVOID_SENSITIVE_EXCEPT = ["fragrance-free", "alcohol-free"]
GOOD_SCORE = 4
BAD_SCORE = 2

# Rating and review-count patterns of the second product source, in order.
LABEL_RATING_AND_REVIEWS = r"(?i)([0-5](?:\.[0-9]+)?)\s+out of\s+5.*?Read\s+([0-9,]+)\s+reviews?"
LABEL_RATING = r"(?i)([0-5](?:\.[0-9]+)?)\s+out of\s+5"
LABEL_REVIEWS = r"(?i)Read\s+([0-9,]+)\s+reviews?"
VISIBLE_RATING = r"^[0-5](?:\.[0-9]+)?$"
VISIBLE_RATING_CLASS = "bv-rnr__"
SCRIPT_RATINGS = [
    r'(?i)"ratingValue"\s*:\s*"?([0-5](?:\.[0-9]+)?)"?',
    r'(?i)"averageRating"\s*:\s*"?([0-5](?:\.[0-9]+)?)"?',
    r'(?i)"rating"\s*:\s*"?([0-5](?:\.[0-9]+)?)"?',
]
SCRIPT_REVIEWS = [
    r'(?i)"reviewCount"\s*:\s*"?([0-9,]+)"?',
    r'(?i)"totalReviewCount"\s*:\s*"?([0-9,]+)"?',
    r'(?i)"numReviews"\s*:\s*"?([0-9,]+)"?',
]
LAST_RESORT_RATING = r"(?i)>\s*([0-5]\.[0-9])\s*</div>"
INGREDIENT_DISCLAIMER = "For the latest information"

SYNONYM_PREFIX = "aka "
SYNONYM_SPLIT = r"(?i)\band\b|,"
SYNONYM_PATTERNS = [
    r"(?i)formerly known by its original trade name\s+([^,.]+)",
    r"(?i)generically as\s+([^,.]+)",
    r"(?i)may also be referred to as\s+([^,.]+)",
    r"(?i)also known as\s+([^,.]+)",
]

CANONICAL_NAMES = {
    "aqua": "water",
    "water": "water",
    "vitamin b3": "niacinamide",
    "niacinamide": "niacinamide",
}

REQUIRED_INGREDIENT_FIELDS = ["ingredient_url", "raw_ingredient_name", "full_description"]
OPTIONAL_INGREDIENT_FIELDS = [
    "rating", "benefits", "ingredient_categories", "at_a_glance_points",
    "synonyms", "concerns", "safety_notes",
]

INGREDIENT_FIELDS = [
    "record_id", "batch_id", "source_name", "source_type", "source_url", "ingredient_url",
    "ingestion_date", "collected_at", "extraction_status", "missing_fields",
    "pipeline_version", "raw_file_path", "raw_ingredient_name",
    "normalized_ingredient_name", "canonical_ingredient_name", "rating", "benefits",
    "ingredient_categories", "at_a_glance_points", "full_description", "synonyms",
    "concerns", "safety_notes", "related_ingredients",
]
FAILED_FIELDS = [
    "ingredient_url", "http_status", "attempts", "error_type", "error_message", "collected_at",
]

ACCESS_DENIED_STATUS = [401, 403]
NOT_FOUND_STATUS = [404]
RETRYABLE_STATUS = [429, 500, 502, 503, 504]
MIN_BODY_LENGTH = 500

# Selector parts of the ingredient dictionary pages.
DICTIONARY_LINK = "/ingredient-dictionary/ingredient-"
CONTENT_CLASSES = ["IngredientPagestyles__Content", "IngredientPagestyles__Wrapper"]
CONTENT_TAGS = ["main", "body"]
DESCRIPTION_CLASS = "IngredientPagestyles__Description"
LIST_RATING_CLASS = "ColoredIngredientRating"
LIST_DESCRIPTION_CLASS = "IngredientList__Description"

# --- End of fixed values. ---
