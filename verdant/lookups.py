"""Lookup tables and thresholds.

A ``Profile`` bundles every domain-specific value the engine needs (source
labels, enum tokens, region map, thresholds).  ``REFERENCE_PROFILE`` holds the
values of the original wild-flora catalogue; other domains pass their own.
All of these are small literals that travel inside the plan as expressions,
never as joined tables.
"""

from __future__ import annotations

from dataclasses import dataclass, field

# ---------------------------------------------------------------------------
# FIXED VALUES — must equal the original catalogue's for identical results.
# ---------------------------------------------------------------------------

# Field labels of the flora source pages.
LABEL_NAME_HE = "שם הצמח"
LABEL_NAME_LAT = "שם מדעי"
LABEL_COMMON_EN = "שם עממי"
LABEL_LIFE_FORM = "צורת חיים"
LABEL_BLOOM = "עונת הפריחה"
LABEL_HABITAT = "בית גידול"
LABEL_DISTRIB = "תפוצה בארץ"
LABEL_NAME_AR = "שם ערבי"
LABEL_STATUSES = "_statuses"
LABEL_LEAF = "צורת העלה"
LABEL_LEAF_EDGE = "שפת העלה"
LABEL_STEM = "צורת הגבעול"
LABEL_PETALS = "מס' עלי כותרת"

# Status label -> flag.
STATUS_MAP = {
    "צמח מוגן": "protected", "בסכנת הכחדה": "red_list", "צמח צופני": "nectar",
    "תבלין ו/או צמח מאכל": "edible", "צמח המשומש לרפואה": "medicinal",
    "צמח רעיל": "poisonous", "צמח אלרגני": "allergenic",
}
STATUS_FLAGS = ("protected", "red_list", "nectar", "edible", "medicinal",
                "poisonous", "allergenic")

# Region -> climate zone.
REGION_ZONE = {
    "חוף הים התיכון": "coastal_plain", "שרון": "coastal_plain", "שפלה": "coastal_plain",
    "עמקים": "northern_valleys", "עמק ירדן עליון": "northern_valleys",
    "בקעת הירדן": "northern_valleys", "גלבוע": "northern_valleys",
    "גליל": "mountains", "גולן": "mountains", "חרמון": "mountains", "כרמל": "mountains",
    "הרי שומרון": "mountains", "הרי יהודה": "mountains",
    "נגב צפוני": "negev_arava", "נגב והרי אילת": "negev_arava", "ערבה": "negev_arava",
    "מדבר יהודה ובקעת ים המלח": "negev_arava", "מדבר שומרון": "negev_arava",
    "עין גדי": "negev_arava",
}

# Life-form text -> enum; checked in this order, first substring hit wins.
LIFE_FORM_MAP = [
    ("עץ", "tree"), ("דקל", "palm"), ("מטפס", "climber"),
    ("בן-שיח", "shrub"), ("שיח", "shrub"),
    ("חד-שנתי", "annual"), ("דו-שנתי", "annual"),
    ("גיאופיט", "bulb"), ("בצל", "bulb"),
    ("סוקולנט", "succulent"), ("בשרני", "succulent"),
    ("שרכים", "fern"), ("שרך", "fern"), ("דגן", "grass"),
    ("עשבוני", "perennial"), ("רב-שנתי", "perennial"),
    ("מים", "aquatic"), ("עשב", "grass"),
]

# Resolver.
CONFIDENCE_THRESHOLD = 88
SPECIES_RANKS = ("SPECIES", "SUBSPECIES", "VARIETY", "FORM")
ACCEPTED_KINGDOM = "Plantae"
CULTIVAR_PATTERN = r"""(?U)\s*'[^']*'|\s*"[^"]*\""""

# Page extraction (flora pages).
PAIR_PATTERN = r'(?s)<span class="prop_name">(.*?)</span>\s*<span class="prop_data">(.*?)</span>'
STATUS_ALT_PATTERN = r'(?s)<div class="prop-img_item">.*?<img[^>]*?alt="([^"]*)".*?</div>'
BLOCK_MARKER = "unauthorized request blocked"
FLORA_URL_PREFIX = "https://www.kkl.org.il/wild-flower/hebrew/plant.asp?ID="

# Seller pages.
TITLE_PATTERN = r'(?s)class="product_title[^"]*"[^>]*>(.*?)</h1>'
PRICE_BLOCK_PATTERN = r'(?s)<p class="price[^"]*">(.*?)</p>'
AMOUNT_PATTERN = r'(?s)<bdi>(.*?)</bdi>'
POT_PATTERN = r'(?U)קוטר\s*\d+\s*ס(?:"|״)?מ|\d+\s*ליטר'
OUT_OF_STOCK_MARKER = 'class="stock out-of-stock"'
SHOP_SEGMENT = "חנות"
PLANT_CATEGORIES = (
    "צמחים-לבית-ולמשרד", "צמחים-למרפסת-ולגינה", "סחלבים",
    "עצים", "סוקולנטים-וקקטוסים", "ירקות",
)

# Seller-name normalisation: marks range, pot tokens, punctuation.
MARKS_PATTERN = "[֑-ׇ]"
POT_TOKENS_PATTERN = r'(?U)קוטר\s*\d+\s*ס(?:"|״)?מ|\d+\s*ס(?:"|״)?מ|\d+\s*ליטר|עציץ\s*\d+'
PUNCT_PATTERN = r"""['"׳״\-–,.()\[\]/]+"""

# Price bands: (upper bound exclusive, band); above the last -> luxury.
PRICE_BANDS = ((40.0, "budget"), (100.0, "mid"), (200.0, "premium"))
TOP_BAND = "luxury"

# Media: file names that signal a drawing rather than a photo.
ILLUSTRATION_PATTERN = (
    r"illustration|drawing|sketch|lithograph|engraving|\bplate\b|\btaf\b|\bfig\.|\bpl\.|"
    r"k[oö]hler|sturm|lindman|thom[eé]|masclef|\bflora\b.*\b(batava|von|der|de)\b|"
    r"english botany|curtis|botanical magazine|nordens flora|deutschlands flora|"
    r"atlas|planche|herbarium|herbier|specimen|\.svg$|kunstformen|1[678]\d\d|190\d"
)
ARTIST_MAX_CHARS = 90
OCCURRENCE_LIMIT = 5

# Status sources.
LISTED_SOURCE = "curated-il-invasive"
POTENTIAL_SOURCE = "griis-israel"
DEFAULT_STATUS_SOURCE = "default"

# Query surface.
PAGE_SIZE = 48
SEARCH_COLUMNS = ("name_he", "scientific_name", "name_ar", "family", "habitat_he")


@dataclass(frozen=True)
class Profile:
    """Domain values for one catalogue build."""

    source: str = "wildflowers"
    identity_source: str = "gbif"
    url_prefix: str = FLORA_URL_PREFIX
    label_name_he: str = LABEL_NAME_HE
    label_name_lat: str = LABEL_NAME_LAT
    # canonical column -> source label (scalars carried from the record)
    scalar_labels: dict = field(default_factory=lambda: {
        "name_ar": LABEL_NAME_AR, "bloom_months_he": LABEL_BLOOM,
        "habitat_he": LABEL_HABITAT, "distribution_il": LABEL_DISTRIB,
        "leaf_shape": LABEL_LEAF, "leaf_margin": LABEL_LEAF_EDGE,
        "stem_shape": LABEL_STEM, "petals": LABEL_PETALS,
    })
    label_common_en: str = LABEL_COMMON_EN
    label_life_form: str = LABEL_LIFE_FORM
    label_statuses: str = LABEL_STATUSES
    label_distribution: str = LABEL_DISTRIB
    status_map: dict = field(default_factory=lambda: dict(STATUS_MAP))
    status_flags: tuple = STATUS_FLAGS
    region_zone: dict = field(default_factory=lambda: dict(REGION_ZONE))
    life_form_map: list = field(default_factory=lambda: list(LIFE_FORM_MAP))
    threshold: int = CONFIDENCE_THRESHOLD
    species_ranks: tuple = SPECIES_RANKS
    accepted_kingdom: str = ACCEPTED_KINGDOM

    @property
    def labels(self) -> list[str]:
        """Every source label the reconciliation reads (pivot list)."""
        out = [self.label_name_he, self.label_name_lat, self.label_common_en,
               self.label_life_form, self.label_statuses]
        out += list(self.scalar_labels.values())
        seen: list[str] = []
        for x in out:
            if x not in seen:
                seen.append(x)
        return seen


REFERENCE_PROFILE = Profile()
