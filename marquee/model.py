"""Constants of the listing model."""

# Categories with their short names and signs, timeframes, vibes, time bands, thresholds and word lists that results depend on.
CATEGORIES = ("Public Lecture", "Workshop / Class", "Concert / Music", "Social / Meetup", "Arts / Exhibition", "Community / Other")
CATEGORY_SLUGS = {
    "Arts / Exhibition": "arts",
    "Community / Other": "community",
    "Concert / Music": "music",
    "Public Lecture": "talks",
    "Social / Meetup": "social",
    "Workshop / Class": "workshops",
}
CATEGORY_EMOJI = {
    "Public Lecture": "🎓",
    "Workshop / Class": "🛠️",
    "Concert / Music": "🎵",
    "Social / Meetup": "🤝",
    "Arts / Exhibition": "🎨",
    "Community / Other": "📌",
}
TIMEFRAMES = ("today", "tomorrow", "this-weekend")
VIBES = ("intellectual", "creative", "hands_on", "social")
VIBE_LABELS = ("stimulating", "creative", "hands on", "social")
TOP_PICK = 7.0
LOW_SCORE = 4.0
MAX_PICKS = 9
NO_DATE = "9999"
VACUOUS_TAGS = (
    "social", "creative", "intellectual", "hands on", "hands-on", "handson", "workshop", "workshops", "talk", "talks", "lecture",
    "lectures", "discussion", "party", "parties", "networking", "meetup", "meetups", "interactive", "live", "entertainment",
    "immersive", "unique", "fun", "exciting", "event", "events", "experience", "special", "popular", "amazing", "interesting",
    "various", "general", "misc", "miscellaneous", "other", "local", "new", "active", "relax", "skills", "learning",
)
# A tag is implied by any tag that one of its patterns finds.
IMPLIED_TAGS = {
    "music": [r"music", r"acoustic", r"^dj$", r"^(singing|classical)$", r"^(jazz|rock|indie|punk|metal|pop|hip hop|electronic|folk|blues|country)$", r"^(piano|reggae|dub)$"],
    "live music": [r"^(concert|band|tribute)$", r"^orchestra$"],
    "concert": [r"^candlelight$"],
    "classical": [r"^(orchestra|opera|vivaldi)$"],
    "singing": [r"^(choir|opera|karaoke|singalong)$"],
    "comedy": [r"\bstand-?up\b", r"\bimprov\b"],
    "theatre": [r"^musical$", r"\bimprov\b", r"^acting$"],
    "musical": [r"^broadway$"],
    "cabaret": [r"^burlesque$"],
    "performance": [r"theatre", r"comedy", r"^(cabaret|circus|drag|open mic)$", r"^(magic|illusion)$"],
    "film": [r"^cinema$"],
    "art": [r"^(gallery|painting|drawing|sculpture|photography|printmaking|portrait)$", r"^(ceramics|mosaic)$", r"^contemporary art$"],
    "craft": [r"^(ceramics|mosaic|textiles|resin)$"],
    "literature": [r"^(poetry|books|writing)$"],
    "fitness": [r"^(yoga|pilates|running)$"],
    "wellness": [r"^(yoga|pilates|meditation|mindfulness)$"],
    "sport": [r"^(surfing|golf|bowls|cheerleading|orienteering|climbing)$"],
    "walking": [r"^hiking$"],
    "outdoor": [r"^(walking|surfing|orienteering|rainforest)$", r"^(sailing|kayak|snorkel|snorkeling|boating|fishing|water)$"],
    "drinks": [r"^(beer|wine|cocktails|coffee|gin|bar)$"],
    "beer": [r"\bbrew(ery|eries|ing)\b"],
    "food": [r"^(dining|cooking|dessert|cake)$"],
    "nature": [r"^(wildlife|gardening|gardens|botanic|rainforest|ecology|hiking)$"],
    "wildlife": [r"^(whales|koala|turtles)$"],
    "environment": [r"^ecology$"],
    "technology": [r"^(engineering|tech|vr)$"],
    "games": [r"^(trivia|bingo|gaming|scavenger hunt)$"],
    "gaming": [r"^arcade$"],
    "shopping": [r"^(market|retail|gifts)$"],
    "tour": [r"^sightseeing$"],
    "community": [r"^charity$"],
    "students": [r"^student$"],
}
# Fixed values of taste: the key groups with their share and target, the floor of counted interactions, the curve and the largest boost.
TASTE_GROUPS = (("tag:", 0.55, 3), ("vibe:", 0.25, 2), ("cat:", 0.2, 1))
TASTE_LEAST, TASTE_CURVE, TASTE_MOST = 3, 1.5, 4.0
LEAST_TAG_WEIGHT = 0.1
EARTH_KM = 6371.0
LEDGER_WEEKS = 26
# Fixed values of the crawl: paths of listings, paths of what is over, other regions.
LISTING_PATH = r"(?i)/(whats[-_]?on|what-s-on|events?|event[-_]?calendar|calendar|shows?|performances?|programme?|line[-_]?up|gigs?|gig[-_]?guide|upcoming|exhibitions?|workshops?|classes|screenings?|buy[-_]?tickets|tickets?|this[-_]?week)(/|$|\?)"
ARCHIVE_PATH = r"(?i)/(past|previous|archive|history|gallery|galleries|recap|wrap-?up)"
OTHER_REGION = r"(?i)(melbourne|sydney|adelaide|perth|hobart|darwin|canberra|newcastle|wollongong|geelong|auckland|wellington|new-zealand|\bnsw\b|\bvic\b|\bwa\b|\bsa\b|\bnt\b|\btas\b|\bact\b)"
# What counts as a date in a text.
DATE_HITS = (
    r"(?i)\b(jan|feb|mar|apr|may|jun|jul|aug|sep|oct|nov|dec)[a-z]*\b",
    r"(?i)\b(mon|tue|wed|thu|fri|sat|sun)[a-z]*\b",
    r"\b\d{1,2}/\d{1,2}(/\d{2,4})?\b",
    r"\b\d{4}-\d{2}-\d{2}\b",
    r"(?i)\b\d{1,2}\s*(am|pm)\b",
)
