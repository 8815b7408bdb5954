"""Fixed values.

Everything here is data that results depend on (word lists, sentinels, formats, thresholds and
published formula constants). Change a value and results change; nothing here is logic.
"""

# --- raw catalogue -----------------------------------------------------------------------------
RAW_COLUMNS = ["name", "fulldescription", "colorname"]
EMPTY_LIST = "[]"  # a cell holding exactly this text is missing
UNKNOWN = "unknown"
MIN_WORDS = 20

# --- cleaned features --------------------------------------------------------------------------
FEATURE_COLUMNS = ["name_clean", "fulldescription_clean", "colors_extracted", "desc_word_count"]
INDEX_METADATA = ["name_clean", "colors_extracted", "fulldescription_clean"]

LIGHT_STOPWORDS = ["the", "a", "an", "is", "are", "was", "were", "it", "its", "this", "that"]

# --- prompt formats (whitespace is part of the format) -----------------------------------------
TRAINING_PROMPT = "Product: {name}\n    Color: {color}\n    Description: {description}\n    "
PRODUCT_TEXT = "Product: {name}\nColor: {color}\nDescription: {description}"
QUERY_TEXT_PLAIN = "Product: {name}"
QUERY_TEXT_COLOR = "Product: {name}\nColor: {color}"
INFERENCE_PROMPT = "Product: {name}\n    Color: {color}\n    Description: "
FEWSHOT_HEADER = "Here are similar products for reference:\n"
FEWSHOT_RULE = "---\n"
FEWSHOT_ASK = "Now generate a description for this product:\n"
DESCRIPTION_MARKER = "Description:"

# --- requests ----------------------------------------------------------------------------------
DEFAULT_TOP_K = 3
MISSING_NAME = "Missing required field: name"
EMPTY_NAME = "Product name cannot be empty"

# --- plan trace --------------------------------------------------------------------------------
STEPS = ["PARSE", "RETRIEVE", "ENRICH", "GENERATE"]
RETRIEVAL_OFF = "FAISS index not loaded — retrieval disabled."
NO_RESULTS = "no results"
NOTHING_TO_INFER_FROM = "no retrieved products to infer from"
NO_COLOR_DATA = "retrieved product has no color data; continuing without color"

# --- sequences, vectors ------------------------------------------------------------------------
SEQUENCE_LENGTH = 256
PAD_ID = 0
UNKNOWN_ID = 1
EMBEDDING_DIM = 384
MODEL_BATCH = 64

# --- BM25 (Okapi, customary defaults) ----------------------------------------------------------
BM25_K1 = 1.5
BM25_B = 0.75
BM25_EPSILON = 0.25

# --- BLEU (cumulative weights; BLEU-3 uses .33, not 1/3) and its smoothing constant ------------
BLEU_WEIGHTS = {
    "BLEU-1": [1.0, 0.0, 0.0, 0.0],
    "BLEU-2": [0.5, 0.5, 0.0, 0.0],
    "BLEU-3": [0.33, 0.33, 0.33, 0.0],
    "BLEU-4": [0.25, 0.25, 0.25, 0.25],
}
BLEU_SMOOTHING = 0.1

# --- sampling ----------------------------------------------------------------------------------
SEED = 42
EVAL_SAMPLE = 50
VALIDATION_SHARE = 0.1
HISTOGRAM_BINS = 50
PREVIEW_ROWS = 3
PREVIEW_CHARS = {"line": 80, "text": 200, "summary": 300}
