"""Fixed values.

Every value in this module must equal the behaviour being reproduced (URL
cleaning, file naming, transcript formatting, job-spec defaults); they are
stated here once, plainly, and imported everywhere else.
"""

# --- Fixed values: URL cleaning -------------------------------------------
# Query keys removed by the canonical URL normaliser (exactly these five).
UTM_PARAMS = ["utm_source", "utm_medium", "utm_campaign", "utm_term", "utm_content"]
# The loose cleaner removes every key starting with this prefix.
UTM_PREFIX = "utm_"

# --- Fixed values: file naming ---------------------------------------------
MAX_FILENAME_LENGTH = 120
# a kept extension must be shorter than this
MAX_EXTENSION_LENGTH = 10
# characters kept by the filename sanitiser; everything else becomes "_"
FILENAME_INVALID_CHARS = r"[^a-zA-Z0-9\-_.]"
UNNAMED_FILE = "unnamed"
INDEX_FILE = "index"
UNKNOWN_DOMAIN = "unknown"
MARKDOWN_EXTENSION = ".md"
# long names: keep this many characters, then "_" + 8 hex chars of md5(url)
LONG_NAME_KEEP = MAX_FILENAME_LENGTH - 33
URL_HASH_CHARS = 8

# --- Fixed values: hashing and sizes ----------------------------------------
HASH_ALGORITHMS = ["md5", "sha1", "sha256"]
BYTE_UNITS = ["B", "KB", "MB", "GB", "TB"]
LAST_BYTE_UNIT = "PB"

# --- Fixed values: document assembly ----------------------------------------
PERSISTENCE_STRATEGIES = ["folder_per_domain", "file_per_domain"]
DOMAIN_PAGE_HEADER = "# {url}\n\n"
DOMAIN_PAGE_SEPARATOR = "\n\n---\n\n"
FLUSH_BUFFER_SIZE = 100
FLUSH_SIZE_MB = 10

# --- Fixed values: job-spec defaults ----------------------------------------
DEFAULT_PERSISTENCE_STRATEGY = "folder_per_domain"
DEFAULT_THREADS = 20
DEFAULT_BASE_DELAY = [2.0, 4.0]
DEFAULT_MAX_DELAY = 30.0
DEFAULT_MAX_RETRIES = 5
DEFAULT_RATE_LIMIT_CODES = [429, 503]
DEFAULT_OUTPUT_FORMAT = "markdown"
DEFAULT_INCLUDE_EXTERNAL = False
DEFAULT_INCLUDE_SUBDOMAINS = True
DEFAULT_MAX_DEPTH = 2
DEFAULT_MAX_PAGES = 100
DEFAULT_SKIP_REGEX = ""

# --- Fixed values: sitemaps -------------------------------------------------
SITEMAP_NAMESPACE = "http://www.sitemaps.org/schemas/sitemap/0.9"
# sitemaps.org protocol limit on <loc> entries per sitemap file
SITEMAP_MAX_LOCS = 50000

# --- Fixed values: video transcripts ------------------------------------------
# Video-id search pattern (first 11 id characters after a recognised prefix).
VIDEO_ID_PATTERN = (
    r"(?:https?:\/\/)?(?:www\.)?(?:youtube\.com\/(?:[^\/\n\s]+\/\S+\/|"
    r"(?:v|e(?:mbed)?)\/|\S*?[?&]v=)|youtu\.be\/)([a-zA-Z0-9_-]{11})"
)
TRANSCRIPT_TIMECODE_PATTERN = r"\[\d+:\d+:\d+\]"
TRANSCRIPT_SPEAKER_PATTERN = r"<\w+>"
TRANSCRIPT_LANGUAGE = "en"
TRANSCRIPT_CANONICAL_URL = "https://www.youtube.com/watch?v={video_id}"
TRANSCRIPT_MARKDOWN = "# YouTube Transcript: {video_id}\n\n**URL:** {url}\n\n{text}"
