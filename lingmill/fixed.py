"""Word lists, lookup tables, thresholds and text markers.

Everything here is data that results depend on, stated in one place. Larger
tables (all language codes with their names, shard counts, seed prompts) are
inputs that the caller loads as DataFrames.
"""

from __future__ import annotations

# --- fixed values: prompt curation -------------------------------------------
UNUSABLE_LANGUAGES = ["unknown", "Klingon", "xx", "zp", "zzp"]
BLOCKED_SUBSTRINGS = ["name", "gpt", "vicuna", "alpaca", "llama", "koala", "claude", "guanaco"]
DETECTION_CONFIDENCE = 0.8
MAX_FIRST_EXCHANGE_TOKENS = 512
PROMPTS_PER_LANGUAGE = 25_000
NEAR_DUPLICATE_DOT = 0.8
ROLLUP_FLOOR = 500

# --- fixed values: preference ranking ----------------------------------------
PROMPTS_TO_JUDGE_PER_LANGUAGE = 100
JUDGE_ROUNDS = 5
RANKING_MARKER = "<<<RANKING>>>"
PROMPT_HEADER = "<<<PROMPT>>>"
RESPONSE_HEADER = "<<<RESPONSE {letter}>>>"
EXPLANATION_HEADER = "<<<EXPLANATION>>>"
HOSTED_MODEL_SUBSTRING = "gpt"

# --- fixed values: generated prompts -----------------------------------------
ENGLISH_NAMES = ["Old English", "Simple English", "English"]
JAPANESE_NAMES = ["Japanese"]
REQUESTS_PER_LANGUAGE = 50
JAPANESE_SEEDS = 50
ENGLISH_SEEDS = 25
PROMPTS_REQUESTED = 150

# --- fixed values: article-grounded data -------------------------------------
PROMPT_MARKER = "<<PROMPT>>"
RESPONSE_MARKER = "<<RESPONSE>>"
NO_INFORMATION_MARKER = "<<NO INFORMATION>>"
NULL_REPLY_ERROR = "Null prompt response"
UNPARSED_REPLY_ERROR = "Failed prompt/response parse"
EXCLUDED_LANGUAGE_CODES = ["be-x-old"]
SELECTED_LANGUAGE_CODES = ["ar", "zh", "ja", "ko", "ru", "es", "pt", "hi", "id"]
POPULAR_LANGUAGE_CODES = [
    "en", "de", "fr", "es", "ru", "pt", "it", "pl", "nl", "uk", "fi", "hu", "et", "tr", "uz",
    "az", "kk", "ar", "he", "am", "my", "sw", "zu", "xh", "yo", "ig", "ta", "ml", "te", "kn",
    "id", "vi", "th", "ms", "jv", "tl", "km", "su", "hi", "mr", "gu", "pa", "bn", "ja", "ko",
    "mi", "sm", "ur", "zh", "zh_min_nan", "pcm", "ha", "om", "ro", "el", "sv", "cs", "fa",
]
QUESTION_CATEGORIES = [
    "explain", "describe", "analyze", "calculate", "synthesize", "summarize", "hypothesize",
]
COMMAND_CATEGORIES = [
    "reformat", "create", "combine", "give details about", "rewrite", "improve", "pretend",
]
ARTICLE_TOKEN_LIMIT = 4_096
CLUSTERS_PER_LANGUAGE = 500
SCORE_FIELDS = [
    "truthfulness", "helpfulness", "succinctness", "importance", "fluency", "naturalness",
]

# --- fixed values: chat revision and cost ------------------------------------
REVISED_INPUT_HEADER = "<REVISED INPUT>"
REVISED_OUTPUT_HEADER = "<REVISED OUTPUT>"
REVISION_TOKEN_CAP = 4_095
REVISION_TOKEN_FACTOR = 2.0
COMPLETION_DOLLARS_PER_MILLION = 30
PROMPT_DOLLARS_PER_MILLION = 10

# --- fixed values: training-set preparation ----------------------------------
VALIDATION_PERCENT = 1
PACK_LENGTHS = [8_192, 32_000]

# --- fixed values: languages asked for generated prompts -----------------------
REQUESTED_LANGUAGES = [
    "English", "German", "French", "Spanish", "Russian", "Portuguese", "Italian", "Polish",
    "Dutch", "Ukrainian", "Finnish", "Hungarian", "Estonian", "Turkish", "Uzbek", "Azerbaijani",
    "Kazakh", "Arabic", "Hebrew", "Amharic", "Chinese", "Burmese", "Swahili", "Zulu", "Xhosa",
    "Yoruba", "Igbo", "Tamil", "Malayalam", "Telugu", "Kannada", "Indonesian", "Vietnamese",
    "Thai", "Malay", "Javanese", "Tagalog", "Khmer", "Sundanese", "Hindi", "Marathi",
    "Gujarati", "Punjabi", "Bengali", "Japanese", "Korean", "Māori", "Samoan", "Urdu",
    "Chinese (Traditional)", "Chinese (Simplified)", "Hausa", "Oromo", "Romanian", "Greek",
    "Swedish", "Czech", "Persian",
]

# --- fixed values: language name to detector code ------------------------------
LANGUAGE_NAME_TO_CODE = {
    "English": "en",
    "Portuguese": "pt",
    "Russian": "ru",
    "Chinese": "zh",
    "Spanish": "es",
    "German": "de",
    "French": "fr",
    "Italian": "it",
    "Japanese": "ja",
    "Korean": "ko",
    "Polish": "pl",
    "Indonesian": "id",
    "Arabic": "ar",
    "Turkish": "tr",
    "Vietnamese": "vi",
    "Ukrainian": "uk",
    "Latin": "la",
    "Danish": "da",
    "Dutch": "nl",
    "Greek": "el",
    "Persian": "fa",
    "Czech": "cs",
    "Hungarian": "hu",
    "Finnish": "fi",
    "Swedish": "sv",
    "Hawaiian": "haw",
    "Serbian": "sr",
    "Scots": "gd",
    "Romanian": "ro",
    "Corsican": "co",
    "Galician": "gl",
    "Slovak": "sk",
    "Thai": "th",
    "Hebrew": "he",
    "Tsonga": "ts",
    "Bulgarian": "bg",
    "Malay": "ms",
    "Catalan": "ca",
    "Esperanto": "eo",
    "Norwegian": "no",
    "Norwegian Nynorsk": "nn",
    "Somali": "so",
    "Afrikaans": "af",
    "Occitan": "oc",
    "Quechua": "qu",
    "Swahili": "sw",
    "Macedonian": "mk",
    "Uzbek": "uz",
    "Croatian": "hr",
    "Guarani": "gn",
    "Breton": "br",
    "Interlingue": "ie",
    "Malagasy": "mg",
    "Luxembourgish": "lb",
    "Volapük": "vo",
    "Haitian Creole": "ht",
    "Tongan": "to",
    "Manx": "gv",
    "Basque": "eu",
    "Sanskrit": "sa",
    "Bangla": "bn",
    "Interlingua": "ia",
    "Oromo": "om",
    "Xhosa": "xh",
    "Hindi": "hi",
    "Samoan": "sm",
    "Slovenian": "sl",
    "Kinyarwanda": "rw",
    "Estonian": "et",
    "Latvian": "lv",
    "Wolof": "wo",
    "Tagalog": "tl",
    "Waray": "war",
    "Welsh": "cy",
    "Māori": "mi",
    "Seselwa Creole French": "crs",
    "Bosnian": "bs",
    "Scottish Gaelic": "gd",
    "Faroese": "fo",
    "Southern Sotho": "st",
    "Lithuanian": "lt",
    "Tatar": "tt",
    "Romansh": "rm",
    "Tswana": "tn",
    "Khasi": "kha",
    "Icelandic": "is",
    "Irish": "ga",
    "Bislama": "bi",
    "Ganda": "lg",
    "Lingala": "ln",
    "Afar": "aa",
    "Belarusian": "be",
    "Javanese": "jv",
    "Albanian": "sq",
    "Hausa": "ha",
    "Maltese": "mt",
    "Nyanja": "ny",
    "Kalaallisut": "kl",
    "Azerbaijani": "az",
    "Fijian": "fj",
    "Western Frisian": "fy",
    "Hmong": "hmn",
    "Aymara": "ay",
    "Nauru": "na",
    "Akan": "ak",
    "Yoruba": "yo",
    "Morisyen": "mfe",
    "Kazakh": "kk",
    "Cebuano": "ceb",
    "Turkmen": "tk",
    "Shona": "sn",
    "Tajik": "tg",
    "Sundanese": "su",
    "Kyrgyz": "ky",
    "Zhuang": "za",
    "Sinhala": "si",
    "Igbo": "ig",
    "Mongolian": "mn",
    "Rundi": "rn",
    "Amharic": "am",
    "Uyghur": "ug",
    "Sindhi": "sd",
    "Tamil": "ta",
    "Urdu": "ur",
    "Zulu": "zu",
    "Swati": "ss",
    "Northern Sotho": "nso",
    "Venda": "ve",
    "Armenian": "hy",
    "Cherokee": "chr",
    "Lao": "lo",
    "Kurdish": "ku",
    "Bashkir": "ba",
    "Burmese": "my",
    "Pashto": "ps",
    "Abkhazian": "ab",
    "Punjabi": "pa",
    "South Ndebele": "nr",
    "Nepali": "ne",
    "Marathi": "mr",
    "Malayalam": "ml",
    "Yiddish": "yi",
    "Sango": "sg",
    "Inupiaq": "ik",
    "Kannada": "kn",
    "Tigrinya": "ti",
    "Tibetan": "bo",
    "Odia": "or",
    "Georgian": "ka",
    "Khmer": "km",
}
