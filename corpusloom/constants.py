"""Fixed values of the data model: column lists, labels, lexicons, markers, thresholds.

Everything here is data.  Results are only comparable between systems when these values
are identical, so they are written out plainly; every operator that uses one of them takes
it as a parameter with the value below as the default.
"""

from __future__ import annotations

# --- fixed values: schemas -------------------------------------------------------------
SFT_COLUMNS = ["instruction", "response", "source", "language", "urgency_level", "confidence"]
DPO_COLUMNS = ["prompt", "chosen", "rejected", "source", "language"]
LEVELS = ["max", "moderate", "deferred"]

# --- fixed values: source names and instruction prefixes ---------------------------------
SOURCE_MCQ_INDEX = "frenchmedmcqa"
SOURCE_QA = "medquad"
SOURCE_MCQ_LETTER = "mediql_mcqu"
SOURCE_OPEN_QA = "mediql_oeq"
PREFIX_QUESTION = "Question médicale : "
PREFIX_EXAM_QUESTION = "Question médicale (examen) : "
PREFIX_CORRECT_ANSWER = "Réponse correcte : "

# --- fixed values: urgency keywords, French then English ----------------------------------
MAX_KEYWORDS = [
    "douleur thoracique", "difficultés respiratoires", "perte de conscience",
    "arrêt cardiaque", "hémorragie", "anaphylaxie", "AVC", "urgence vitale",
    "danger vital", "convulsions", "coma", "détresse respiratoire",
    "chest pain", "difficulty breathing", "loss of consciousness", "cardiac arrest",
    "hemorrhage", "anaphylaxis", "stroke", "life-threatening", "emergency", "seizure",
    "unconscious",
]
DEFERRED_KEYWORDS = [
    "rhume", "légère douleur", "fatigue chronique", "médecin traitant", "rendez-vous",
    "peut attendre", "suivi régulier", "vaccin", "prévention", "dépistage", "bilan",
    "contrôle", "consultation", "vitamines", "nutrition", "hygiène",
    "allergie saisonnière", "eczéma", "acné", "insomnie", "constipation", "régime",
    "cold", "mild pain", "chronic fatigue", "general practitioner", "appointment",
    "can wait", "routine", "follow-up", "vaccine", "prevention", "screening", "check-up",
    "annual", "wellness", "vitamins", "nutrition", "hygiene", "seasonal allergy",
    "eczema", "acne", "insomnia", "constipation", "diet", "supplement", "lifestyle",
    "rehabilitation", "physical therapy", "counseling", "medication management", "refill",
]
KEYWORD_CONFIDENCE = 0.8
DEFAULT_LEVEL = "moderate"
DEFAULT_CONFIDENCE = 0.7

# --- fixed values: structured answer -------------------------------------------------------
LEVEL_LABELS = {
    "max": "URGENCE MAXIMALE",
    "moderate": "URGENCE MODÉRÉE",
    "deferred": "URGENCE DIFFÉRÉE",
}
UNKNOWN_LEVEL_LABEL = "URGENCE INDÉTERMINÉE"
LEVEL_ADVICE = {
    "max": "Appelez le 15 (SAMU) ou rendez-vous aux urgences immédiatement. Ne restez pas seul.",
    "moderate": "Consultez un médecin ou une unité de soins urgents dans les 24 à 48 heures.",
    "deferred": "Prenez rendez-vous avec votre médecin traitant dans les prochains jours.",
}
BODY_MARKER = "Évaluation clinique : "
ADVICE_MARKER = "\n\nRecommandations : "
MAX_BODY_CHARS = 500
ELLIPSIS = "..."

# --- fixed values: text patterns (Java regex syntax) -----------------------------------------
HTML_PATTERN = r"(?iu)<[^>]+>|&[a-z]+;"
URL_PATTERN = r"(?iu)https?://|www\."
MIN_RESPONSE_WORDS = 20
LABEL_WINDOW_CHARS = 150
JUNK_TOKENS = ["ForCanBeConverted", "𫟦"]
PLACEHOLDER_PATTERN = r"<[A-Z_]{2,}>"
MIN_SENTENCES = 3
MIN_SENTENCE_CHARS = 10  # a sentence counts when it is longer than this
EXPORT_TOKEN = "URGENCE"

# --- fixed values: preference pairs ------------------------------------------------------------
WRONG_LEVEL = {"max": "moderate", "moderate": "deferred", "deferred": "moderate"}
LEVEL_PRIORITY = {"max": 2, "moderate": 1, "deferred": 0}
SOURCE_SYNTHETIC = "sft_synthetic"
SOURCE_HARD_NEGATIVE = "sft_hard_negative"
SEED = 42
SFT_TARGET_ROWS = 6500
PAIR_TARGET_ROWS = 500

# --- fixed values: personal data -----------------------------------------------------------------
ENTITY_TYPES = ["PERSON", "LOCATION", "DATE_TIME", "PHONE_NUMBER", "EMAIL_ADDRESS", "NRP"]
PERSON_MIN_SCORE = 0.85
REVIEW_BELOW_SCORE = 0.7
REVIEW_ROWS = 20
EXAMPLE_ROWS = 10
EXAMPLE_CHARS = 200
# Terms that are never masked as a person: eponyms, examinations, organs, institutions,
# drugs, gene names, and the words of the urgency labels.
PERSON_ALLOWLIST = [
    "alzheimer", "parkinson", "huntington", "crohn", "hodgkin", "addison", "cushing",
    "graves", "hashimoto", "wilson", "marfan", "turner", "down", "raynaud", "behcet",
    "sjogren", "sjögren", "brugada", "wolff", "klinefelter", "noonan", "prader", "willi",
    "angelman", "rett", "duchenne", "becker", "charcot", "marie", "tooth", "gaucher",
    "fabry", "niemann", "pick", "pompe", "hurler", "hunter", "sanfilippo", "morquio",
    "tay", "sachs", "canavan", "krabbe", "batten", "spielmeyer", "vogt", "aicardi",
    "goutières", "aicardi-goutières", "lennox", "gastaut", "dravet", "landau", "kleffner",
    "sturge", "weber", "von hippel", "lindau", "neurofibromatosis", "tuberous", "sézary",
    "szary", "paget", "bowen", "kaposi", "burkitt", "wilms", "ewing", "pott", "bright",
    "berger", "henoch", "schönlein", "wegener", "goodpasture", "buerger", "takayasu",
    "horton", "kawasaki", "still", "felty", "reiter", "behçet", "whipple", "menetrier",
    "zollinger", "ellison", "sipple", "wermer", "verner", "morrison", "ogilvie",
    "hirschsprung", "meckel", "peutz", "jeghers", "lynch", "cowden", "bannayan", "riley",
    "day", "fanconi", "blackfan", "diamond", "shwachman", "kostmann", "chediak",
    "higashi", "wiskott", "aldrich", "bruton", "digeorge", "treacher", "collins",
    "pierre", "robin", "goldenhar", "charge", "vacter", "vacterl",
    "basedow", "quincke", "biermer", "leriche", "osler", "rendu", "barre", "guillain",
    "millard", "gubler",
    "x-ray", "x ray", "mri", "ct scan", "ercp",
    "lung", "heart", "kidney", "liver", "spleen", "colon",
    "nih", "cdc", "who", "nhlbi",
    "coversyl", "perindopril", "levothyrox", "doliprane", "aspirin",
    "glut", "brca", "cftr", "mthfr",
    "arp", "ags",
    "urgence", "maximale", "modérée", "différée",
]

# --- fixed values: gates, metrics, service limits ----------------------------------------------
MAX_CLASS_GAP_PCT = 10.0
MIN_SPLIT_ROWS = {"train": 4000, "val": 500, "test": 500}
METRIC_THRESHOLDS = {
    "recall_max": 0.75,
    "f2_macro": 0.60,
    "format_compliance": 0.70,
    "accuracy": 0.60,
}
LENGTH_STEPS = [512, 1024, 2048]
REQUEST_MIN_CHARS = 10
REQUEST_MAX_CHARS = 2000
ERROR_CHARS = 120
SLA_P95_MS = 5000.0
DISCLAIMER = "⚠️ Cet agent est un outil d'aide au triage, pas un diagnostic médical."

# --- fixed values: chat template -------------------------------------------------------------------
TURN_START = "<|im_start|>"
TURN_END = "<|im_end|>"
EMPTY_THINKING = "<think>\n\n</think>\n"
# ``{site}`` is the name of the institution, supplied by the caller.
SYSTEM_PROMPT_TEMPLATE = """Tu es un agent de triage médical pour le {site}.
Analyse les symptômes décrits et fournis :
1. Le niveau d'urgence : URGENCE MAXIMALE / URGENCE MODÉRÉE / URGENCE DIFFÉRÉE
2. Une évaluation clinique brève
3. Des recommandations concrètes

Règles absolues :
- Réponds TOUJOURS en français, même si les symptômes sont décrits en anglais.
- N'utilise jamais de marqueurs d'anonymisation comme <PERSON>, <LOCATION>, <DATE>, etc.
- Si tu ne connais pas un nom propre, omets-le simplement.

⚠️ Cet agent est un outil d'aide au triage, pas un diagnostic médical."""
DEFAULT_SITE = "Centre Hospitalier"


def system_prompt(site: str = DEFAULT_SITE) -> str:
    """The system message for one institution."""
    return SYSTEM_PROMPT_TEMPLATE.replace("{site}", site)
