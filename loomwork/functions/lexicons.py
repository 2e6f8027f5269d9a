"""Word lists and patterns whose values results depend on. Every function that uses one takes it as a parameter."""

# Lists, names and patterns that must be as they are for equal results.

ENTITY_TYPES = ("crop", "disease", "pest", "chemical", "practice", "nutrient", "soil", "climate")
RELATION_TYPES = ("affects", "causes", "treats", "prevents", "requires", "interacts_with", "found_in", "applied_to")
STEP_TYPES = (
    "context_setup", "knowledge_application", "causal_reasoning", "comparison", "condition_analysis",
    "evidence_integration", "conclusion",
)
FACTUAL_TYPES = ("knowledge_application", "causal_reasoning", "evidence_integration")
CONFIDENCES = ("high", "medium", "low")
ACTIONS = ("remove_step", "merge_steps", "revise_step", "insert_step", "add_evidence", "adjust_confidence")
PRIORITIES = ("P0", "P1", "P2")

CONTENT_KEYWORDS = (
    "crop", "plant", "soil", "farm", "seed", "grain", "agriculture", "harvest", "cultivar", "fertiliz", "pesticid",
    "irrigat", "tillage", "livestock", "cattle", "poultry", "dairy", "wheat", "rice", "corn", "soybean", "cotton",
    "disease resistance", "pest management", "weed control", "compost", "manure", "organic farming", "greenhouse",
    "orchard", "vineyard", "pasture", "nursery", "horticult", "agronom", "planting", "growing season",
    "nutrient deficiency", "soil pH", "soil fertility", "crop rotation", "cover crop", "intercropping",
    "food production", "food security", "food processing",
)

TITLE_KEYWORDS = (
    "crop", "plant", "soil", "farm", "seed", "grain", "fruit", "vegetable", "fertiliz", "pesticid", "herbicid",
    "irrigat", "harvest", "cultivar", "livestock", "cattle", "poultry", "dairy", "wheat", "rice", "corn", "maize",
    "soybean", "cotton", "tobacco", "sugarcane", "potato", "tomato", "lettuce", "pepper", "bean", "pea", "carrot",
    "onion", "apple", "grape", "citrus", "berry", "nut ", "almond", "walnut", "disease", "pest", "weed", "fungus",
    "nematode", "insect", "compost", "manure", "mulch", "tillage", "plough", "plow", "agricult", "horticult", "agronom",
    "silvicult", "greenhouse", "nursery", "orchard", "vineyard", "pasture", "organic", "sustainable", "regenerative",
    "permaculture", "drought", "flood", "frost", "climate", "bacteria", "virus", "pathogen", "symbiosis", "mycorrhiz",
    "pollinator", "bee", "butterfly", "bird", "garden", "landscape", "turf", "lawn", "food", "nutrition", "vitamin",
    "mineral", "ethanol", "biodiesel", "biofuel", "biomass",
)

COMMON_TITLE_WORDS = ("agriculture", "crop", "plant", "soil", "farm", "livestock")

CATEGORY_EXCLUDE = (
    "fictional", "game", "video", "film", "music", "book", "character", "sample return", "space", "lunar", "martian",
    "earthworks", "engineering", "geotechnical", "by country", "by continent", "by region", "templates", "stubs", "lists",
)
CATEGORY_INCLUDE = (
    "crop", "plant", "soil", "farm", "agri", "pest", "disease", "fertiliz", "irrigat", "seed", "grain", "cereal",
    "vegetable", "fruit", "nut", "legume", "root", "leaf", "herb", "spice", "fiber", "forage", "cover", "livestock",
    "dairy", "poultry", "compost", "manure", "organic", "tillage", "harvest", "cultivar", "variety", "breed", "hybrid",
    "fungus", "bacteria", "virus", "nematode", "weed", "insect", "sand", "clay", "loam", "sediment", "contamination",
    "improver",
)

ENTITY_LEXICON = (
    "corn", "wheat", "rice", "soybean", "cotton", "tomato", "potato", "lettuce", "cabbage", "collard", "pepper", "bean",
    "pea", "carrot", "onion", "garlic", "cucumber", "squash", "pumpkin", "melon", "strawberry", "blueberry", "apple",
    "grape", "citrus", "orange", "lemon", "peach", "cherry", "plum", "pear", "avocado", "mango", "blight", "rust",
    "mildew", "wilt", "rot", "spot", "scab", "aphid", "beetle", "caterpillar", "mite", "nematode", "weevil", "thrips",
    "whitefly", "skipper", "borer", "fly", "mosquito", "fungus", "bacteria", "virus", "pathogen", "nitrogen",
    "phosphorus", "potassium", "lime", "compost", "mulch", "fertilizer", "pesticide", "herbicide", "insecticide",
    "fungicide", "irrigation", "drainage", "tillage", "cover crop", "drought", "frost", "heat", "flooding", "erosion",
    "salinity", "acidity", "alkalinity", "ph", "organic matter",
)

QUESTION_PREFIXES = ("how ", "what ", "why ", "when ", "where ", "which ", "is ", "are ", "can ", "do ", "does ")

FILLER_WORDS = (
    "okay", "so", "let", "me", "i", "need", "to", "should", "right", "basically", "actually", "well", "just", "really",
    "like", "things", "stuff", "very", "quite", "somewhat", "rather", "pretty", "maybe", "perhaps", "probably",
    "certainly", "definitely", "simply", "merely", "honestly", "frankly", "obviously", "clearly", "essentially",
    "fundamentally", "literally", "seriously", "absolutely", "totally", "completely", "entirely", "exactly", "precisely",
    "approximately", "roughly", "generally", "typically", "usually", "normally", "frequently", "occasionally",
    "sometimes", "often", "always", "never", "rarely", "seldom", "hardly", "barely", "scarcely", "um", "uh", "er", "ah",
    "you", "we", "they", "it", "the", "a", "an", "is", "are", "was", "were", "be", "been", "being", "have", "has", "had",
    "do", "does", "did", "will", "would", "could", "might", "may", "can", "shall", "must", "this", "that", "these",
    "those", "here", "there",
)
#: Single characters only: the test is made character by character.
CJK_STOPCHARS = "的了是在我有和就不人都一上也很到说要去你会着看好这他她它们那被从把对让用为以所但而哪谁吗吧呢啊呀哦嗯么与及或等之其此该本各每中内外前后左右大小多少"

UNIT_NUMBERS = r"(?i)\d+\s*(?:°[CF]|%|lbs?|oz|gal|inches?|ft|feet|cm|mm|pH|ppm|mg|kg|acres?|ha)"
BARE_NUMBERS = r"\b\d+\.?\d*\b"
PROPER_NOUNS = r"(?<=[a-z.] )\b[A-Z][a-z]+\b"
TECHNICAL = r"\b(?:NPK|Bt|pH|UAN|MAP|DAP|KCl|Ca|Mg|Fe|Zn|Mn|Cu|B|S)\b"
EVIDENCE = (
    r"(?i)(?:extension|university|USDA|NRCS|FAO|research|study|studies|publication|guide|handbook|fact\s*sheet)",
    r"(?i)(?:according to|published|journal|doi|pmid|ref\.?\s*\d)",
    r"(?i)(?:UMass|Purdue|Penn State|Cornell|Iowa State|NC State|UC Davis)",
)
IMPERATIVES = (
    r"(?i)\b(?:apply|add|use|mix|spray|water|plant|test|check|remove|prune|stake|mulch|rotate|monitor|scout|treat|fertilize|"
    r"irrigate|drain|cover|space|thin|harvest|incorporate|broadcast|side-dress|drench|soak|measure|adjust|maintain|install|"
    r"ensure|avoid|reduce|increase|select|choose|consider|confirm|identify)\b"
)
CONNECTIVES = (
    r"(?i)\b(?:therefore|however|additionally|furthermore|moreover|consequently|thus|hence|because|since|although|while|"
    r"whereas|first|second|third|next|then|finally|also|importantly|specifically|for example|in summary|overall|"
    r"alternatively|otherwise|meanwhile|subsequently)\b"
)
HEADERS, NUMBERED, BULLETS, BOLD = r"(?md)^#{1,3}\s", r"(?md)^\s*\d+[\.\)]\s", r"(?md)^\s*[-*•]\s", r"\*\*[^*]+\*\*"
LOCATIONS = r"\b(?:in|near|around)\s+([A-Z][a-z]+(?:\s+[A-Z][a-z]+)*)"
PRACTICES = r"\b(?:organic|conventional|no-till|raised.bed|greenhouse|hydroponic)\b"
CROPS = (
    r"\b(?:peppers?|tomatoes?|corn|wheat|soybean|potato|blueberry|carrot|kale|collard|beet|bean|flower|pistachio|wheat)\b"
)
CONDITIONS = r"\b(?:drought|heat|hail|wind|frost|erosion|lodging|pest|disease|mold|flood)\b"

COMPARISON_WEIGHTS = {
    "specificity": 0.15, "evidence": 0.20, "actionability": 0.15, "coherence": 0.15, "structure": 0.10, "constraint_coverage": 0.25,
}
QUALITY_WEIGHTS = {
    "faithfulness": 0.25, "structure": 0.15, "information_density": 0.10, "logical_completeness": 0.25, "traceability": 0.15,
    "step_order": 0.10,
}
QUALITY_WEIGHTS_WITHOUT_ORDER = {
    "faithfulness": 0.25, "structure": 0.20, "information_density": 0.15, "logical_completeness": 0.25, "traceability": 0.15,
}
LINK_SKIP = (
    "Special:", "File:", "Category:", "Template:", "Help:", "Wikipedia:", "Talk:", "User:", "Portal:", "#", "cite_note", "mw-",
)
BLOCK_TAGS = (
    "gallery", "math", "chem", "source", "code", "pre", "imagemap", "timeline", "hiero", "mapframe", "maplink",
)
BARE_BLOCK_TAGS = ("includeonly", "noinclude", "onlyinclude")
