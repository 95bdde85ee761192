"""Fixed values the results depend on.

Everything here is data, not logic: dictionaries, constants and patterns
whose exact values must be kept for results to match the behaviour the engine
reproduces. They are stated plainly and in their natural order.
"""

from __future__ import annotations

# --- FIXED VALUES: slang dictionary (batch jobs), in its published order ---------
SLANG = {
    "u": "you",
    "r": "are",
    "cuz": "because",
    "dont": "do not",
    "wont": "will not",
    "im": "I am",
    "yall": "you all",
    "gonna": "going to",
    "gotta": "got to",
    "hafta": "have to",
    "lemme": "let me",
    "kinda": "kind of",
    "sorta": "sort of",
    "lol": "laughing out loud",
    "lmao": "laughing my ass off",
    "btw": "by the way",
    "fyi": "for your information",
    "smh": "shaking my head",
    "idk": "I don't know",
    "ftw": "for the win",
    "brb": "be right back",
    "tbh": "to be honest",
    "wyd": "what you doing",
    "salty": "bitter or upset",
    "simp": "someone who shows excessive sympathy",
    "sus": "suspicious",
    "vibe check": "assessing someone's energy or mood",
    "lit": "exciting or excellent",
    "yeet": "to throw something with force",
    "ghosting": "sudden cut-off communication",
    "shook": "shocked or surprised",
    "extra": "over the top",
    "b4": "before",
    "gtg": "got to go",
    "omg": "oh my god",
    "imo": "in my opinion",
    "tldr": "too long; didn't read",
    "ikr": "I know right",
    "rofl": "rolling on the floor laughing",
    "yolo": "you only live once",
    "ama": "ask me anything",
    "asap": "as soon as possible",
    "nsfw": "not safe for work",
    "afaik": "as far as I know",
    "wtf": "what the f***",
    "irl": "in real life",
    "afk": "away from keyboard",
    "np": "no problem",
    "fr": "for real",
    "srsly": "seriously",
    "fam": "family",
    "flex": "show off",
    "shade": "disrespect",
    "clout": "influence or power",
    "cap/no cap": "lie/no lie",
    "stan": "an obsessive fan",
    "thirsty": "desperate for attention",
    "fomo": "fear of missing out",
    "bussin": "really good",
    "bet": "agreement or approval",
    "cheugy": "out of touch or trying too hard",
}
# The interactive variant carries the same entries without the last two.
SLANG_APP = {k: v for k, v in SLANG.items() if k not in ("bet", "cheugy")}

# --- FIXED VALUES: cleaning patterns (Java regex, Python `re` semantics) ----------
# (?U): Unicode \w \s \b as in Python 3 str patterns; (?d): `.` stops at \n only.
# Python's \s also holds U+001C..U+001F, hence the explicit range.
WS = r"[\s\x1c-\x1f]"
NON_WS = r"[^\s\x1c-\x1f]"
LINK_PATTERN = r"(?Ud)http" + NON_WS + r"+|www" + NON_WS + r"+|@" + NON_WS + r"+|<.*?>"
EMAIL_PATTERN = r"(?U)\b\w+@\w+\.\w+\b"
MENTION_PATTERN = r"(?U)@\w+"
USER_REF_PATTERN = r"(?U)\bu/\w+\b"
OPEN_PAREN_PATTERN = r"(?U)" + WS + r"*\(" + WS + r"*"
CLOSE_PAREN_PATTERN = r"(?U)" + WS + r"*\)" + WS + r"*"
SPACE_RUN_PATTERN = r"(?U)" + WS + r"+"

# Word characters used by the engine's own tokenisers (same class in Spark and
# in the SQL oracle, so both engines split identically).
WORD = r"[\p{L}\p{N}_]"

# Sentiment tokens: runs without white space, outer punctuation taken off unless nothing else is there,
# so that contractions and emoticons stay whole.
CHUNK = r"[^ \t\n\r\f\x0B]+"
OUTER_PUNCTUATION = r"^[^\p{L}\p{N}_]+|[^\p{L}\p{N}_]+$"

# --- FIXED VALUES: rule-based sentiment constants (published method) -------------
SENT_BOOST = 0.293          # booster increment
SENT_BOOST_DECAY = (1.0, 0.95, 0.9)   # booster at distance 1, 2, 3
SENT_NEGATE = -0.74         # negation factor
SENT_CAPS = 0.733           # ALL-CAPS emphasis when the text mixes case
SENT_BUT_BEFORE = 0.5       # weight before the first "but"
SENT_BUT_AFTER = 1.5        # weight after it
SENT_EXCLAIM = 0.292        # per "!", at most 4
SENT_EXCLAIM_MAX = 4
SENT_QUESTION = 0.18        # per "?", when 2 or 3
SENT_QUESTION_MANY = 0.96   # when more than 3
SENT_ALPHA = 15.0           # compound = s / sqrt(s^2 + alpha)
SENT_POSITIVE = 0.05        # label thresholds
SENT_NEGATIVE = -0.05

# --- FIXED VALUES: other formats ------------------------------------------------
NO_TOPIC = "No Topic"
TOPIC_JOIN = " + "
SHARE_PREFIX = "https://twitter.com/intent/tweet?text="

# --- FIXED VALUES: English stop words (181), in their published order -------------
ENGLISH_STOP_WORDS = (
    "i", "me", "my", "myself", "we", "our", "ours", "ourselves", "you", "your", "yours", "yourself", "yourselves",
    "he", "him", "his", "himself", "she", "her", "hers", "herself", "it", "its", "itself", "they", "them", "their",
    "theirs", "themselves", "what", "which", "who", "whom", "this", "that", "these", "those", "am", "is", "are",
    "was", "were", "be", "been", "being", "have", "has", "had", "having", "do", "does", "did", "doing", "a", "an",
    "the", "and", "but", "if", "or", "because", "as", "until", "while", "of", "at", "by", "for", "with", "about",
    "against", "between", "into", "through", "during", "before", "after", "above", "below", "to", "from", "up",
    "down", "in", "out", "on", "off", "over", "under", "again", "further", "then", "once", "here", "there", "when",
    "where", "why", "how", "all", "any", "both", "each", "few", "more", "most", "other", "some", "such", "no",
    "nor", "not", "only", "own", "same", "so", "than", "too", "very", "s", "t", "can", "will", "just", "don",
    "should", "now", "i'll", "you'll", "he'll", "she'll", "we'll", "they'll", "i'd", "you'd", "he'd", "she'd",
    "we'd", "they'd", "i'm", "you're", "he's", "she's", "it's", "we're", "they're", "i've", "we've", "you've",
    "they've", "isn't", "aren't", "wasn't", "weren't", "haven't", "hasn't", "hadn't", "don't", "doesn't", "didn't",
    "won't", "wouldn't", "shan't", "shouldn't", "mustn't", "can't", "couldn't", "cannot", "could", "here's",
    "how's", "let's", "ought", "that's", "there's", "what's", "when's", "where's", "who's", "why's", "would",
)


def english_stop_words() -> tuple[str, ...]:
    return ENGLISH_STOP_WORDS
