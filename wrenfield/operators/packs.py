"""Demonstration packs. The words are configuration: these are words that the driver tables have."""

from __future__ import annotations

from .rules import Rule

# The veto keys in their order.
VETO_KEYS = (
    "token_craft_workshop", "networking_drinks", "corporate_tech", "generic_social_dating", "life_drawing",
    "wellness_upsell", "immersive_walkthrough", "classical_concert", "language_learning", "expat_international",
    "writing_groups", "tabletop_gaming", "technical_developer_training", "startup_investment", "dating_events",
    "wrong_sports", "sport_viewing", "discussion_group", "public_speaking", "wrong_age",
    "wrong_age_30s_40s", "young_professionals", "pub_quiz", "karaoke", "escape_room",
    "pub_crawl", "dj_practice", "london_walks", "blocked_organiser",
)
# Veto keys that look at the title and organiser only, and their exemptions' keys.
TITLE_VETOES = ("tabletop_gaming", "wrong_sports")
EXEMPTED = {"classical_concert": ("anhe", "annd"), "technical_developer_training": ("reat",)}
_DEMO = (
    "esndha", "clown", "idiot", "moron", "trash", "scum", "license", "ener ench", "pour", "tiontion",
    "queque", "hetion", "intion", "thanedble", "haea", "attion", "osci", "therhean", "enlich", "ersch",
    "lement", "athe", "hash", "inea", "edly", "ensch", "ndtion", "loser", "pathetic",
)
VETOES = [Rule(k, (w,), "title" if k in TITLE_VETOES else "blob", EXEMPTED.get(k, ())) for k, w in zip(VETO_KEYS, _DEMO)]

# Categories in their order, with the words of the title or of the whole text that tell them.
FORMATS = [
    Rule("Outdoor", ("hike", "hikes", "hiking", "walk", "walking tour", "guided walk", "nature walk", "canal walk", "riverside walk", "photo walk", "photowalk", "art walk", "ramble", "rambling", "trail", "trek", "stroll", "wander", "peaks", "day trip", "circular"), "name"),
    Rule("Outdoor", scope="name", pattern=r"(?i)\b\d+\s*(?:or\s+\d+\s*)?miles?\b"),
    Rule("Outdoor", ("hike", "hikes", "hiking")),
    Rule("Creative social", ("sketch", "drawing", "painting", "collage", "pottery", "ceramics", "printmaking", "embroidery", "write club", "silent writing", "art jam", "creative workshop", "art workshop")),
    Rule("Workshop", ("workshop", "hands-on", "hands on", "hackathon", "hackday", "hack day", "hack night", "hacknight", "build session", "jam session", "bring your laptop", "vibe coding", "live coding", "course", "training session", "masterclass")),
    Rule("Immersive experience", ("immersive", "installation", "sensory experience", "multisensory", "interactive art", "multimedia")),
    Rule("Film", ("film screening", "cinema", "movie night", "documentary screening", "screening", "short film")),
    Rule("Book event", ("book launch", "book signing", "author event", "book reading", "book talk")),
    Rule("Exhibition", ("gallery",), "name"),
    Rule("Exhibition", ("exhibition", "museum visit", "museum")),
    Rule("Talk", ("talk",), "name"),
    Rule("Talk", ("panel", "presentation", "fireside chat", "keynote", "speaker", "lecture", "seminar", "symposium", "demo day", "demo night")),
    Rule("Talk", scope="name", pattern=r"(?i)meetup\s*#\d"),
    Rule("Wellness", ("breathwork", "sound bath", "sound healing", "yoga", "meditation", "wellness", "spa")),
    Rule("Concert", ("dj",), "name"),
    Rule("Concert", ("concert", "gig", "live music", "dj set", "music festival", "tribute")),
]
DEFAULT_FORMAT = "Social meetup"
# Retired categories and what they became; names of formats and their canonical ones.
RETIRED = {"Hackday": "Workshop", "Course": "Workshop", "Walking tour": "Outdoor", "Museum visit": "Exhibition"}
CANONICAL = {
    "workshop / course": "Workshop",
    "meetup / networking": "Social meetup",
    "creative / social": "Creative social",
    "wellness / breathwork": "Wellness",
    "wellness / spa": "Wellness",
    "talk/panel": "Talk",
    "concert / festival": "Concert",
    "cultural visit / museum": "Museum visit",
    "museum": "Museum visit",
    "trial class (movement/dance?)": "Workshop",
    "outdoor / nature": "Outdoor",
    "book launch": "Book event",
}
REPEATED = ("Workshop", "Social meetup", "Wellness")
SOCIAL_THROUGH = ("Workshop", "Creative social", "Outdoor")
PASSIVE = ("Talk", "Film", "Exhibition")

#: Words of names of parks.
PARKS = ("park", "part 3")

#: Words of the signals.
SIGNALS = {
    "ai": ("error",), "vinyl": ("esndha",), "hands_on": ("purchase", "reat"), "hands_on_title": ("view",), "creative": ("clown", "anhe"), "production": ("idiot",),
    "social": ("part 1",), "artists": ("part 2",), "immersive": ("annd",), "climbing": ("part 3",), "breathwork": ("hash",), "series": ("night 7",), "organisers": ("click", "src3"),
    "venues": ("venue 3",), "pompous": ("athe",), "thought": ("lement",), "networking": ("night 9",), "violence": ("scum",), "corporate": ("pour",),
}

HARD_RULES = [Rule(f"hard_{i:02d}", (w,), "name" if i % 3 == 0 else "blob") for i, w in enumerate(("night 1", "night 2", "idiot", "clown", "part 4", "night 33", "attion", "hash", "pathetic", "night 41", "moron", "trash"), 1)]
HARD_ORGANISERS = ("logout", "src7", "src11")
