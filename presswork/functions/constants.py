"""Fixed values that decide results: label lists, sizes, the URL shape, feed names."""

# Class order of the sentiment model.
SENTIMENTS = ("negative", "neutral", "positive")

# Class order of the emotion model.
EMOTIONS = (
    "admiration", "amusement", "anger", "annoyance", "approval", "caring", "confusion",
    "curiosity", "desire", "disappointment", "disapproval", "disgust", "embarrassment",
    "excitement", "fear", "gratitude", "grief", "joy", "love", "nervousness", "optimism",
    "pride", "realization", "relief", "remorse", "sadness", "surprise", "neutral",
)

# Label of an article in which the model knows no word; window and chunk sizes.
NEUTRAL = "neutral"
WINDOW_TOKENS = 512
CHUNK_ROWS = 500

# URLs of one silver batch in a run: a batch is a folder, so it holds far more than a chunk of work.
BATCH_ROWS = 5_000_000

# End of a manifest line that names a feed archive; 0-based feed column of the URL.
FEED_SUFFIX = ".gkg.csv.zip"
FEED_URL_COLUMN = 4

# Character classes of the URL shape, spelled out so that every regex engine agrees.
WORD_CHARS = r"\p{L}\p{N}_"
SPACE_CHARS = (
    r"\x{09}-\x{0d}\x{1c}-\x{20}\x{85}\x{a0}\x{1680}"
    r"\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
)
URL_TRAILING_PUNCTUATION = r"`!\[\]{};:'\".,?«»“”‘’"
