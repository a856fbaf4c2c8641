"""Domain defaults. Every operator takes these as parameters; the values below are only the defaults."""

# Kcal bands, (exclusive upper bound, label), and the label above the last bound.
SCORE_BANDS = ((80, "A"), (160, "B"), (270, "C"), (400, "D"))
SCORE_TOP = "E"

# Cooking-time classes, (inclusive upper bound in minutes, label).
TIME_BANDS = ((30, "rapide"), (60, "moyen"))
TIME_TOP = "long"
TIME_MISSING = "inconnu"
TIME_CLASSES = ("rapide", "moyen", "long")

# Ranges and sizes used by the dashboard aggregates.
COOK_MEAN_RANGE = (1, 600)
KCAL_CAP = 3500
KCAL_BINS = 60
COOK_CURVE_RANGE = (1, 300)
COOK_CURVE_WIDTH = 5
SATURATES_RANGE = (0, 60)
SUGARS_RANGE = (0, 100)
SCATTER_ROWS = 2000
TOP_ITEMS = 15
TOP_INDEX_ITEMS = 30

# Outlier thresholds and report length.
OUTLIER_ITEMS = 40
OUTLIER_KCAL = 3000
OUTLIER_MINUTES = 1440
OUTLIER_ROWS = 50

# Search result sizes and record-card length.
FULL_TEXT_ROWS = 8
SEARCH_ROWS = 20
CARD_ITEMS = 14

# Labels shown for missing data.
NO_STEPS = "1. Instructions non disponibles."
NO_ITEMS = "Non disponible"
UNKNOWN = "?"

# Completeness classes, best first.
COMPLETE = "100% Parfaite (Toutes les colonnes des tables sont remplies)"
USABLE = "Partielle (Image + Nutrition de base + Ingrédients ok)"
INCOMPLETE = "Incomplète (Manque des données critiques)"

# Okapi BM25 parameters (Robertson & Zaragoza 2009).
BM25_K1 = 1.2
BM25_B = 0.75

MACROS = ("fat_g", "protein_g", "salt_g", "saturates_g", "sugars_g")
