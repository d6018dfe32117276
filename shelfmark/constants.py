"""Fixed values. Results depend on these exact words, formats and thresholds."""

# Catalog host, its accepted alias and the id prefix.
HOST = "github.com"
HOST_ALIASES = ("www.github.com",)
PLATFORM = "github"

# Words that mark a curated list.
LIST_WORD = "awesome"
LIST_TOPIC = "awesome-list"
LIST_PHRASES = ("awesome list", "awesome repository")

# Default discovery requests.
LIST_NAME_PATTERNS = ("awesome", "awesome-list", "awesome-*")
LIST_TOPICS = ("awesome", "awesome-list", "awesome-lists", "curated-list", "resources")
DEFAULT_TOPICS = ("awesome", "awesome-list", "awesome-lists", "curated", "resources", "developer-resources")
HITS_PER_QUERY = 100

# Primary language (lower case) -> category.
LANGUAGE_CATEGORIES = {
    "python": "Python",
    "rust": "Rust",
    "go": "Go",
    "javascript": "JavaScript",
    "typescript": "TypeScript",
    "java": "Java",
    "c++": "C++",
    "cpp": "C++",
    "c#": "C#",
    "csharp": "C#",
    "c": "C",
    "swift": "Swift",
    "kotlin": "Kotlin",
    "ruby": "Ruby",
    "shell": "CLI",
    "html": "Web Development",
}

# The older, exact-name language table.
LEGACY_LANGUAGE_CATEGORIES = {
    "python": "Python",
    "rust": "Rust",
    "go": "Go",
    "javascript": "JavaScript",
    "typescript": "TypeScript",
    "java": "Java",
    "cpp": "C++",
    "c": "C",
    "swift": "Swift",
    "kotlin": "Kotlin",
    "ruby": "Ruby",
}

MAX_CATEGORIES = 5

# License keys, matched as substrings.
PERMISSIVE_LICENSES = (
    "mit", "apache-2.0", "bsd", "bsd-2-clause", "bsd-3-clause", "isc", "unlicense", "0bsd",
    "psf-2.0", "wtfpl", "zlib",
)
COPYLEFT_LICENSES = (
    "gpl-2.0", "gpl-3.0", "agpl-3.0", "lgpl-2.1", "lgpl-3.0", "mpl-2.0", "epl-1.0",
    "cddl-1.0", "spl-1.0",
)

# Names of vulnerability tools, matched as substrings of name or description.
VULNERABILITY_TOOLS = (
    "dependabot", "snyk", "snyk-lab", "trivy", "grype", "safety", "bandit", "semgrep", "sonar",
    "codeql", "oss-index", "npm audit", "auditjs", "retire", "license-checker", "pip-audit",
)

# Weights of the eight score components.
SCORE_WEIGHTS = {
    "popularity": "0.20",
    "activity": "0.20",
    "maintenance": "0.20",
    "community": "0.15",
    "documentation": "0.10",
    "license": "0.05",
    "security": "0.05",
    "awesome_quality": "0.05",
}
SCORE_COMPONENTS = tuple(SCORE_WEIGHTS)

# Days between two refreshes by health status.
REFRESH_POLICY = {
    "ACTIVE": 1,
    "MAINTAINED": 3,
    "SLOW": 7,
    "STALE": 30,
    "ARCHIVED": 90,
    "UNKNOWN": 14,
}
REFRESH_FALLBACK_DAYS = 14

# Fields compared between two snapshots.
DIFF_FIELDS = (
    "stars", "forks", "issues", "language", "description", "license", "topics", "archived",
    "pushed_at", "updated_at", "health_status", "score_overall",
)
TRENDING_GAIN = 500
STALE_DAYS = 180
TRENDING_SCORE = 75

REQUIRED_FIELDS = ("id", "owner", "name", "url", "collected_at")

# Content extraction.
API_SPEC_NAMES = (
    "openapi.json", "openapi.yaml", "openapi.yml", "swagger.json", "swagger.yaml", "swagger.yml",
)
DOC_SUFFIXES = (".md", ".mdx", ".rst", ".txt")
README_LISTING = "readme"
LISTINGS = ("docs", "doc", "documentation", "wiki", "")
MAX_REPOSITORIES = 100
MAX_FILES_PER_LISTING = 10
MAX_BYTES_PER_FILE = 200_000
MAX_BYTES_PER_REPOSITORY = 1_000_000

# Advisory urls.
OSV_URL = "https://osv.dev/vulnerability/"
KEV_URL = "https://www.cisa.gov/known-exploited-vulnerabilities-catalog"
CVE_URL = "https://www.cve.org/CVERecord?id="
SUMMARY_LENGTH = 500

UNCATEGORIZED = "Uncategorized"
UNKNOWN_HEALTH = "UNKNOWN"

# Inclusion and exclusion rules.
SPAM_PHRASES = ("click here", "buy now", "spam", "phishing", "crypto airdrop", "free ethereum")
EXCLUDED_LICENSES = ("GPL-2.0-only", "GPL-3.0-only", "AGPL-3.0-only")
EXCLUDED_LANGUAGES = ("",)
MIN_STARS = 10
MIN_FORKS = 0

# Markdown patterns. (?d) keeps "\n" the only line end, (?m) anchors per line.
LINK_PATTERN = r"\[([^\]]*)\]\(([^)]+)\)"
HEADING_PATTERN = r"(?dm)^#{1,6}\s+(.+)$"
ITEM_LINK_PATTERN = r"^[\s\-\*]*\[?([^\]]*)\]?\s*\((https?://[^)]+)\)"
BARE_URL_PATTERN = r"(?i)(https?://github\.com/[a-zA-Z0-9_.-]+/[a-zA-Z0-9_.-]+)"
BARE_URL_PATTERN_EXACT = r"(https?://github\.com/[a-zA-Z0-9_.-]+/[a-zA-Z0-9_.-]+)"
BRACKET_URL_PATTERN = r"<(https://github\.com/[a-zA-Z0-9_.-]+/[a-zA-Z0-9_.-]+)>"
BULLET_LINK_PATTERN = r"(?m)^[\s\-\*]*\[([^\]]+)\]\((https?://[^\)]+)\)"
TOC_PATTERN = r"(?m)^\[?\[?[^\]]+\]:?\s+#"
BADGE_PATTERN = r"!\[[^\]]*\]\([^)]*\)"
TABLE_PATTERN = r"(?dm)^\|.*\|.*\|"

# Heading decoration.
HEADING_NOISE = r"[\[\](){}*_`#•·|]+"
HEADING_EMOJI = r"[\x{1F000}-\x{1FAFF}\x{2190}-\x{21FF}\x{2300}-\x{27BF}\x{2B00}-\x{2BFF}\x{FE0F}\x{200D}]+"
HEADING_EDGES = "-–—:|,"
