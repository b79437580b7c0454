"""Fixed values of the log contract: patterns, formats and constants.

Everything in this file is a fixed value: it has to equal what the log format and
the published masking rules use, or results differ. Logic lives elsewhere. ``[^\\n]`` stands for
"any character": Java's dot would also stop at carriage returns and other line ends.
"""

# --- pieces of one access-log line -------------------------------------------------
HEX = "[a-fA-F0-9]"
UUID = f"{HEX}{{8}}-{HEX}{{4}}-{HEX}{{4}}-{HEX}{{4}}-{HEX}{{12}}"
HASH = f"{HEX}{{40}}"

REMOTE_ADDR = r"[\.a-fA-F0-9:]+"
BRACKETED_TIME = r"\[[^\n]*?\]"
TOKEN = "[^ ]+"
HTTP_VERSION = r"HTTP/[\.\d]+"
DIGITS = r"\d+"
DECIMAL = r"[\.\d]+"
QUOTED_TEXT = r"[^\n]+?"
VERSION = r"\d+\.[^ ]+"
MISS = "miss"

# --- bracketed times ----------------------------------------------------------------
LOG_TIME = (
    r"^\[(?:\d{2}/\w{3}/\d{4}:\d{2}:\d{2}:\d{2} [+-]\d{4}"
    r"|\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}[+-]\d{2}:\d{2})\]$"
)

# --- file names ---------------------------------------------------------------------
ACCESS_LOG_NAME = r"^access_.*\.pkg\.julia.*\.((gz)|(zst))"
DATED_NAME = r".*-(\d+).((gz)|(zst))"
SERVER_IN_NAME = r"^access_(.*)\.pkg\.julia"
DEFAULT_WINDOW_DAYS = 31 + 2
MIRROR_WINDOW_DAYS = 30

# --- compressed-file signatures (hex of the leading bytes) --------------------------
MAGIC = {"gzip": "1f8b", "xz": "fd377a585a00", "zstd": "28b52ffd", "bzip2": "425a68"}

# --- request classes ----------------------------------------------------------------
PACKAGE_PREFIX = "/package"
ARTIFACT_PREFIX = "/artifact"
RESOURCE_PATHS = "/package|/artifact|/registry"
NOISE_URLS = ["/", "/favicon.ico", "/robots.txt"]
NOISE_URL_PREFIXES = ["/meta", "/badges/", "/detail/", "/docs/", "/logs/"]
NOISE_AGENT = "statping"
MIRROR_PATHS = "julia/(package|artifact|registry)/"
MIRROR_SERVED = r'"GET [^\n]*" 200 (\d+)'
UNKNOWN_PROVIDER = "<unknown>"

# --- keyed address hash -------------------------------------------------------------
HASH_ROUNDS = 16
BUCKET_MASK = 0x00000FFF
SAMPLE_MASK = 0xFFFFC000
REGISTERS = 4096

# --- masking ------------------------------------------------------------------------
IPV4 = (
    r"((25[0-5]|(2[0-4]|1{0,1}[0-9]){0,1}[0-9])\.){3,3}"
    r"(25[0-5]|(2[0-4]|1{0,1}[0-9]){0,1}[0-9])"
)
LOCAL_TIME_IN_TEXT = r"\d\d/\w\w\w/\d\d\d\d:\d\d:\d\d:\d\d"
ISO_TIME_IN_TEXT = r"\d\d\d\d-\d\d-\d\dT\d\d:\d\d:\d\d"
MASKED_FROM = "2020-09-01 00:00:00"
MASKED_DAYS = 91
MASK_RANDOM_SHARE = 0.5

# --- byte units ---------------------------------------------------------------------
# The ZB step is an addition; without it the ninth step has no suffix.
BYTE_UNITS = ["B", "KB", "MB", "GB", "TB", "PB", "EB", "ZB", "YB"]
