"""Values that decide results and therefore must not drift.

Everything in this module is a fixed value: formats, limits and patterns the
results depend on.  Code elsewhere refers to them by name.
"""

# Audio formats, as lower-case file suffixes.
AUDIO_SUFFIXES = (".mp3", ".mp4", ".mpeg", ".mpga", ".m4a", ".wav", ".webm", ".ogg", ".flac")

# Sizes and durations of the transcription step.
MAX_UPLOAD_BYTES = 26214400  # 25 MiB; exactly this size still goes in one piece
SAFE_UPLOAD_MIB = 24
PART_SECONDS = 600
TRANSCRIPT_LANGUAGE = "fr"
TRANSCRIPT_MODEL = "whisper-large-v3"

# Texts of errors that results are compared by.
UNSUPPORTED = "Unsupported format: "
TOO_LARGE = ("File too large: ", "MB")
NOT_SPLIT = "Failed to split audio file"

# Quotas of the transcription service.
REQUESTS_PER_MINUTE = 20
REQUESTS_PER_DAY = 2000
AUDIO_SECONDS_PER_HOUR = 7200
AUDIO_SECONDS_PER_DAY = 28800

# Retries.
MAX_ATTEMPTS = 3
MODEL_LOADING_WAIT_S = 20
TRANSCRIBE_RATE_WAIT_S = 60
TRANSCRIBE_ERROR_WAIT_S = 5

# Chunking.
SENTENCE_BREAK = "(?<=[.!?]) +"
CHUNK_SIZE = 1000
CHUNK_OVERLAP = 100

# Selection and search.
DEFAULT_MARK = "2000-01-01 00:00:00"
EPISODES_PER_RUN = 5
CATALOGUE_CANDIDATES = 5
HTML_SNIPPET_CHARS = 200
NEAREST_K = 3
EMBEDDING_DIM = 384
UNKNOWN_SOURCE = "Unknown"

# The metadata record kept with every episode and chunk.
EPISODE_FIELDS = ("title", "podcast", "audio_url", "spotify_url", "published_date")

# Digits that are not decimal digits (superscripts, subscripts, circled and
# so on), which a title keeps although the decimal-digit class does not hold them.
OTHER_DIGITS = (
    r"\x{B2}-\x{B3}\x{B9}\x{1369}-\x{1371}\x{19DA}\x{2070}\x{2074}-\x{2079}"
    r"\x{2080}-\x{2089}\x{2460}-\x{2468}\x{2474}-\x{247C}\x{2488}-\x{2490}\x{24EA}"
    r"\x{24F5}-\x{24FD}\x{24FF}\x{2776}-\x{277E}\x{2780}-\x{2788}\x{278A}-\x{2792}"
    r"\x{10A40}-\x{10A43}\x{10E60}-\x{10E68}\x{11052}-\x{1105A}\x{1F100}-\x{1F10A}"
)

# Letters and decimal digits of Unicode 13.0.1 to 15.1, which the regular
# expressions of Java 17 do not class as such yet.
NEWER_LETTERS = (
    r"\x{870}-\x{887}\x{889}-\x{88E}\x{8B5}\x{8C8}-\x{8C9}\x{C5D}\x{CDD}\x{170D}\x{171F}"
    r"\x{1B4C}\x{2C2F}\x{2C5F}\x{9FFD}-\x{9FFF}\x{A7C0}-\x{A7C1}\x{A7D0}-\x{A7D1}\x{A7D3}"
    r"\x{A7D5}-\x{A7D9}\x{A7F2}-\x{A7F4}\x{10570}-\x{1057A}\x{1057C}-\x{1058A}"
    r"\x{1058C}-\x{10592}\x{10594}-\x{10595}\x{10597}-\x{105A1}\x{105A3}-\x{105B1}"
    r"\x{105B3}-\x{105B9}\x{105BB}-\x{105BC}\x{10780}-\x{10785}\x{10787}-\x{107B0}"
    r"\x{107B2}-\x{107BA}\x{10F70}-\x{10F81}\x{11071}-\x{11072}\x{11075}"
    r"\x{1123F}-\x{11240}\x{11740}-\x{11746}\x{11AB0}-\x{11ABF}\x{11F02}"
    r"\x{11F04}-\x{11F10}\x{11F12}-\x{11F33}\x{11F50}-\x{11F59}\x{12F90}-\x{12FF0}"
    r"\x{1342F}\x{13441}-\x{13446}\x{16A70}-\x{16ABE}\x{16AC0}-\x{16AC9}"
    r"\x{1AFF0}-\x{1AFF3}\x{1AFF5}-\x{1AFFB}\x{1AFFD}-\x{1AFFE}\x{1B11F}-\x{1B122}"
    r"\x{1B132}\x{1B155}\x{1DF00}-\x{1DF1E}\x{1DF25}-\x{1DF2A}\x{1E030}-\x{1E06D}"
    r"\x{1E290}-\x{1E2AD}\x{1E4D0}-\x{1E4EB}\x{1E4F0}-\x{1E4F9}\x{1E7E0}-\x{1E7E6}"
    r"\x{1E7E8}-\x{1E7EB}\x{1E7ED}-\x{1E7EE}\x{1E7F0}-\x{1E7FE}\x{2A6DE}-\x{2A6DF}"
    r"\x{2B735}-\x{2B739}\x{2EBF0}-\x{2EE5D}\x{31350}-\x{323AF}"
)
