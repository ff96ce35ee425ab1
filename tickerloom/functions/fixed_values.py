"""Results depend on these exact words, patterns and constants."""

# Finance words counted as positive.
POSITIVE_FINANCE_WORDS = """
profit gains growth increase rise surge rally bull bullish
outperform beat exceed strong robust solid impressive optimistic
upgrade buy recommend positive momentum breakthrough success
expansion acquisition merger dividend earnings revenue
""".split()

# Finance words counted as negative.
NEGATIVE_FINANCE_WORDS = """
loss losses decline decrease fall drop plunge crash bear bearish
underperform miss disappoint weak poor terrible concerning pessimistic
downgrade sell avoid negative volatility uncertainty risk bankruptcy
lawsuit investigation fraud scandal deficit debt
""".split()

# Weights of the composite score.
COMPOSITE_WEIGHTS = {
    "vader_compound": 0.3,
    "textblob_polarity": 0.2,
    "finbert": 0.4,
    "finance_sentiment_ratio": 0.1,
}

# Headline prefixes of news wires, removed wherever they occur.
HEADLINE_PREFIXES = (
    "Reuters - ",
    "Bloomberg - ",
    "CNBC - ",
    "MarketWatch - ",
    "Yahoo Finance - ",
    "AP News - ",
)

# Boilerplate patterns, removed in this order, any case.
BOILERPLATE_PATTERNS = (
    r"reuters\s*-\s*",
    r"bloomberg\s*-\s*",
    r"cnbc\s*-\s*",
    r"marketwatch\s*-\s*",
    r"yahoo finance\s*-\s*",
    r"ap news\s*-\s*",
    r"associated press\s*-\s*",
    r"\(reuters\)",
    r"\(bloomberg\)",
    r"copyright.*?reuters",
    r"all rights reserved",
    r"terms of use",
    r"privacy policy",
)

# Sources counted as credible when the source name contains one.
CREDIBLE_SOURCES = (
    "Reuters",
    "Bloomberg",
    "Wall Street Journal",
    "Financial Times",
    "CNBC",
    "MarketWatch",
    "Barrons",
    "Forbes",
    "Investors Business Daily",
)

# Stop words of the headline word count.
HEADLINE_STOP_WORDS = """
the a an and or but in on at to for of with by as is are was were
""".split()

# English stop words dropped by the tokenizer (the public NLTK list;
# its forms with an apostrophe cannot occur once cleaning has removed apostrophes).
ENGLISH_STOP_WORDS = """
i me my myself we our ours ourselves you your yours yourself yourselves
he him his himself she her hers herself it its itself
they them their theirs themselves what which who whom this that these those
am is are was were be been being have has had having do does did doing
a an the and but if or because as until while of at by for with about against
between into through during before after above below to from up down in out on
off over under again further then once here there when where why how all any
both each few more most other some such no nor not only own same so than too
very s t can will just don should now d ll m o re ve y ain aren couldn didn
doesn hadn hasn haven isn ma mightn mustn needn shan shouldn wasn weren won wouldn
""".split()

# Contractions the tokenizer writes as two words.
SPLIT_CONTRACTIONS = ("can not", "gim me", "gon na", "got ta", "lem me", "wan na")

# Sectors of the cross-asset features.
SECTORS = {"tech": ("AMD", "ASML"), "defense": ("GD",)}

# Name fragments that mark sentiment columns.
SENTIMENT_KEYWORDS = ("vader", "textblob", "finbert", "composite")
SUMMARY_KEYWORDS = ("vader", "textblob", "finbert", "finance", "composite")

# Overlapping families of the feature summary.
FEATURE_FAMILIES = {
    "Sentiment Features": ("vader", "textblob", "finbert", "composite", "sentiment"),
    "Technical Features": ("sma", "ema", "rsi", "macd", "bb_", "volume", "volatility"),
    "Text Features": ("text_", "word_", "tfidf", "uppercase"),
    "Temporal Features": ("month", "day", "quarter", "week", "year", "is_"),
    "Lag Features": ("lag_",),
    "Interaction Features": ("interaction",),
}

# First matching class wins in the feature metadata.
FEATURE_CLASSES = (
    ("sentiment", "Sentiment analysis score", ("vader", "textblob", "finbert", "composite")),
    ("technical", "Technical analysis indicator", ("sma", "ema", "rsi", "macd", "bb_")),
    ("text", "Text-based feature", ("text_", "word_", "tfidf")),
    ("temporal", "Time-based feature", ("month", "day", "quarter", "week")),
    ("lag", "Lagged feature", ("lag_",)),
    ("interaction", "Feature interaction", ("interaction",)),
    ("market", "Market-based feature", ("volume", "volatility", "return")),
)

MARKET_TIMEZONE = "US/Eastern"
MARKET_CLOSE_HOUR = 16
TRADING_DAYS_PER_YEAR = 252
RISK_FREE_RATE = 0.02
LONG_THRESHOLD = 0.6
SHORT_THRESHOLD = 0.4
TRANSACTION_COST = 0.001
INITIAL_CAPITAL = 100000.0
