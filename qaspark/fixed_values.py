"""Fixed values.

The word lists, look-up tables, patterns and limits below have to be exactly these
for the results to be right. They hold no logic.
"""

# --- limits -----------------------------------------------------------------

START_YEAR = 2015
END_YEAR = 2024
NETWORK_TOP_N = 75
SITE_TOP_N = 50
PATTERN_TOP_N = 20
MAX_CLUSTER_SIZE = 200
MIN_EDGE_WEIGHT = 3
MAX_PER_YEAR = 500
CACHE_TTL_DAYS = 30

# --- the language dimension ---------------------------------------------------

LANGUAGES = [
    {
        "language": "python",
        "tag": "python",
        "display_name": "Python",
        "color": "#3776AB",
        "related_tags": [
            "pandas", "numpy", "django", "flask", "scikit-learn",
            "tensorflow", "pytorch", "matplotlib", "asyncio", "fastapi",
        ],
    },
    {
        "language": "javascript",
        "tag": "javascript",
        "display_name": "JavaScript",
        "color": "#F7DF1E",
        "related_tags": [
            "node.js", "react.js", "vue.js", "typescript", "express",
            "next.js", "angular", "webpack", "promise", "async-await",
        ],
    },
    {
        "language": "java",
        "tag": "java",
        "display_name": "Java",
        "color": "#ED8B00",
        "related_tags": [
            "spring", "spring-boot", "maven", "gradle", "hibernate",
            "junit", "android", "multithreading", "jdbc", "rest",
        ],
    },
    {
        "language": "go",
        "tag": "go",
        "display_name": "Go",
        "color": "#00ADD8",
        "related_tags": [
            "goroutine", "channels", "gin", "golang", "interface",
            "struct", "go-modules", "http", "context", "generics",
        ],
    },
]

DEFAULT_COLOR = "#888888"

SURVEY_FILE_NAMES = ["results.csv", "survey_results_public.csv"]
SURVEY_HAVE_COLUMN = "LanguageHaveWorkedWith"
SURVEY_WANT_COLUMN = "LanguageWantToWorkWith"

# Tags left out of the co-tag ranking.
HUB_TAGS = ["python", "javascript", "java", "go", "python-3.x"]

# --- text -----------------------------------------------------------------------

# The English list of Spark's StopWordsRemover.
ENGLISH_STOPWORDS = """
i me my myself we our ours ourselves you your yours yourself yourselves he him his himself she her hers
herself it its itself they them their theirs themselves what which who whom this that these those am is are
was were be been being have has had having do does did doing a an the and but if or because as until while of
at by for with about against between into through during before after above below to from up down in out on
off over under again further then once here there when where why how all any both each few more most other
some such no nor not only own same so than too very s t can will just don should now i'll you'll he'll she'll
we'll they'll i'd you'd he'd she'd we'd they'd i'm you're he's she's it's we're they're i've we've you've
they've isn't aren't wasn't weren't haven't hasn't hadn't don't doesn't didn't won't wouldn't shan't shouldn't
mustn't can't couldn't cannot could here's how's let's ought that's there's what's when's where's who's why's
would
""".split()

DOMAIN_STOPWORDS = [
    "use", "using", "used",
    "get", "getting", "got",
    "want", "need", "like",
    "know", "work", "working",
    "run", "running",
    "make", "try", "trying",
    "call", "calling", "return",
    "set", "add", "check",
    "fix", "fixing", "find", "finding",
    "show", "display", "create", "update",
    "code", "function", "variable",
    "value", "type", "object",
    "class", "method", "print",
    "data", "file", "list",
    "string", "number", "output",
    "input", "result", "answer",
    "question", "example",
    "following", "below", "above",
    "way", "possible", "help",
    "issue", "problem", "error",
    "different", "simple", "new",
    "multiple", "single", "custom",
    "given", "specific", "particular",
    "properly", "correctly", "automatically",
    "still", "already", "always",
]

LANGUAGE_STOPWORDS = {
    "python": ["python", "py"],
    "javascript": ["javascript", "js"],
    "java": ["java"],
    "go": ["go", "golang"],
}

ERROR_PATTERNS = [
    "[A-Z][a-zA-Z]+Error",
    "[A-Z][a-zA-Z]+Exception",
    "TypeError",
    "ValueError",
    "AttributeError",
    "ImportError",
    "KeyError",
    "IndexError",
    "NullPointerException",
    "ReferenceError",
    "SyntaxError",
]

NOISE_LABEL = "（ノイズ）"

# --- display --------------------------------------------------------------------

READABLE_LABELS = {
    "django": "Django", "flask": "Flask", "numpy": "NumPy", "pandas": "pandas",
    "tensorflow": "TensorFlow", "keras": "Keras", "selenium": "Selenium",
    "tkinter": "tkinter (GUI)", "sqlalchemy": "SQLAlchemy",
    "python_3": "Python 3 / ファイル操作", "pip": "pip / 環境構築",
    "reactjs": "React.js", "ecmascript_6": "ES6 / モジュール",
    "html": "HTML / DOM", "node": "Node.js / Express", "css": "CSS / スタイル",
    "jquery": "jQuery", "angularjs": "Angular", "vue": "Vue.js",
    "android": "Android", "spring": "Spring / Boot", "swing": "Swing (GUI)",
    "maven": "Maven / ビルド", "javafx": "JavaFX", "firebase": "Firebase",
    "apache": "Apache Spark / Kafka", "multithreading": "マルチスレッド",
    "goroutine": "goroutine / 並行処理", "http": "HTTP / ネットワーク",
    "json": "JSON / シリアライズ", "slice": "スライス / ループ",
    "template": "HTML テンプレート", "mongodb": "MongoDB", "go_gorm": "GORM (ORM)",
    "docker": "Docker / コンテナ", "struct": "構造体 (struct)",
}

COMMUNITY_PREFIX = "コミュニティ "

COMMUNITY_LABELS = {
    "python": ["コア/汎用", "Web スクレイピング", "データ分析", "pandas/CSV", "ML/数値計算", "その他"],
    "javascript": ["コア/汎用", "フロントエンド", "Node.js", "UI フレームワーク", "データ可視化", "その他"],
    "java": ["コア/汎用", "Android", "Spring/Web", "デスクトップ", "その他", "その他"],
    "go": ["コア/汎用", "HTTP/ネット", "データ処理", "ツール/CLI", "クラウド", "データベース"],
}
