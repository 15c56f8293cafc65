"""Word lists behind sentiment, topics and term ranking."""

# Graded sentiment words and their weights.
STRONG_POSITIVE = [
    "amazing", "awesome", "excellent", "fantastic", "incredible", "outstanding", "brilliant",
    "wonderful", "perfect", "superb", "magnificent", "spectacular",
]

POSITIVE = [
    "good", "great", "nice", "love", "like", "best", "better", "beautiful", "helpful", "useful",
    "cool", "fun", "interesting", "solid", "decent", "recommend", "recommended", "worth",
    "quality", "smooth", "easy", "clear", "glad", "happy", "pleased", "satisfied", "works",
    "working", "fixed",
]

MILD_POSITIVE = [
    "ok", "okay", "fine", "alright", "fair", "reasonable", "acceptable", "adequate",
]

STRONG_NEGATIVE = [
    "terrible", "awful", "horrible", "disgusting", "pathetic", "useless", "garbage", "trash",
    "worst", "hate", "despise", "nightmare",
]

NEGATIVE = [
    "bad", "worse", "suck", "sucks", "annoying", "stupid", "dumb", "ridiculous", "frustrating",
    "disappointing", "failed", "broken", "problem", "problems", "issue", "issues", "wrong",
    "error", "bug", "bugs", "difficult", "hard", "confusing", "complicated", "slow", "laggy",
    "glitch", "crash", "crashed",
]

MILD_NEGATIVE = [
    "meh", "boring", "bland", "mediocre", "average", "lacking", "outdated",
]

SENTIMENT_WEIGHTS = (
    (STRONG_POSITIVE, 2.0),
    (POSITIVE, 1.0),
    (MILD_POSITIVE, 0.3),
    (STRONG_NEGATIVE, -2.0),
    (NEGATIVE, -1.0),
    (MILD_NEGATIVE, -0.3),
)

# A negation right before a (strong) positive word costs this much.
NEGATIONS = [
    "not", "no", "never", "dont", "doesn", "isn", "aren", "wasn", "weren",
]
NEGATED_PENALTY = 1.5

# Topic keywords; the order decides ties.
TOPICS = {
    "technical": [
        "code", "programming", "software", "app", "website", "development", "tech", "bug",
        "feature",
    ],
    "gaming": [
        "game", "gaming", "play", "player", "level", "fps", "console", "pc", "steam",
    ],
    "question": [
        "how", "what", "why", "when", "where", "help", "question", "anyone", "does",
    ],
    "discussion": [
        "think", "opinion", "thoughts", "discussion", "debate", "view", "perspective",
    ],
    "news": [
        "news", "update", "announcement", "breaking", "report", "article", "source",
    ],
    "personal": [
        "my", "me", "i", "personal", "experience", "story", "happened", "today",
    ],
}
NO_TOPIC = "general"

# Parts of a text that make it a question.
QUESTION_MARKERS = ["?", "how", "what", "why", "help"]

# Words that are never terms.
TERM_STOP_WORDS = [
    "the", "and", "or", "but", "in", "on", "at", "to", "for", "of", "with", "by", "is", "are",
    "was", "were", "be", "been", "being", "have", "has", "had", "do", "does", "did", "will",
    "would", "could", "should", "may", "might", "a", "an", "as", "if", "it", "he", "she",
    "they", "we", "you", "i", "me", "my", "myself", "this", "that", "these", "those", "am",
    "get", "got", "can", "just", "like", "one", "also", "even", "way", "use", "used", "using",
    "make", "made", "making", "take", "know", "think", "see", "go", "going", "went", "come",
    "now", "time", "people", "than", "first", "its", "who", "user", "tag", "url",
]

# The text columns a row may have, in reading order.
TEXT_COLUMNS = ["title", "text", "full_text", "body", "content"]

# Spark's default English stop words, in its order.
ENGLISH_STOP_WORDS = [
    "i", "me", "my", "myself", "we", "our", "ours", "ourselves", "you", "your", "yours",
    "yourself", "yourselves", "he", "him", "his", "himself", "she", "her", "hers", "herself",
    "it", "its", "itself", "they", "them", "their", "theirs", "themselves", "what", "which",
    "who", "whom", "this", "that", "these", "those", "am", "is", "are", "was", "were", "be",
    "been", "being", "have", "has", "had", "having", "do", "does", "did", "doing", "a", "an",
    "the", "and", "but", "if", "or", "because", "as", "until", "while", "of", "at", "by", "for",
    "with", "about", "against", "between", "into", "through", "during", "before", "after",
    "above", "below", "to", "from", "up", "down", "in", "out", "on", "off", "over", "under",
    "again", "further", "then", "once", "here", "there", "when", "where", "why", "how", "all",
    "any", "both", "each", "few", "more", "most", "other", "some", "such", "no", "nor", "not",
    "only", "own", "same", "so", "than", "too", "very", "s", "t", "can", "will", "just", "don",
    "should", "now", "i'll", "you'll", "he'll", "she'll", "we'll", "they'll", "i'd", "you'd",
    "he'd", "she'd", "we'd", "they'd", "i'm", "you're", "he's", "she's", "it's", "we're",
    "they're", "i've", "we've", "you've", "they've", "isn't", "aren't", "wasn't", "weren't",
    "haven't", "hasn't", "hadn't", "don't", "doesn't", "didn't", "won't", "wouldn't", "shan't",
    "shouldn't", "mustn't", "can't", "couldn't", "cannot", "could", "here's", "how's", "let's",
    "ought", "that's", "there's", "what's", "when's", "where's", "who's", "why's", "would",
]
