"""Text expressions: rich text, labels, cleaning, normalising, truncating, explaining."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from bulwark.functions.seeded import let

# Pattern classes. Whitespace and word characters are the Unicode ones.
SPACE = r"[\s\x0B\x1C-\x1F\x85\p{Z}]"
NOT_SPACE = r"[^\s\x0B\x1C-\x1F\x85\p{Z}]"
WORD_CHAR = r"[\p{L}\p{N}_]"
TECHNIQUE_PATTERN = r"techniques/(T\d+)"

# Labels kept by the fixed-set mapping.
TOP_TECHNIQUES = (
    "T1059", "T1055", "T1071", "T1083", "T1105", "T1027", "T1082", "T1547",
    "T1053", "T1021", "T1112", "T1140", "T1070", "T1036", "T1190",
)
OTHER = "OTHER"
NO_ANNOTATION = "1906"

# Abbreviations expanded by normalize_text, in order.
ABBREVIATIONS = (
    ("C2", "command and control"),
    ("C&C", "command and control"),
    ("APT", "advanced persistent threat"),
    ("IOC", "indicator of compromise"),
    ("IOCs", "indicators of compromise"),
    ("TTPs", "tactics techniques and procedures"),
    ("RAT", "remote access trojan"),
    ("DDoS", "distributed denial of service"),
)

# Keywords that make a sentence important.
KEYWORDS = (
    "attack", "malware", "vulnerability", "exploit", "threat",
    "compromise", "breach", "payload", "backdoor", "trojan",
    "ransomware", "phishing", "spear", "lateral", "persistence",
    "exfiltration", "command", "control", "execution", "discovery",
)

# Patterns of clean_text.
URL_HOST = r"https?://([a-zA-Z0-9.-]+)(?:/[^\s]*)?"
URL = rf"https?://{NOT_SPACE}+"
# A matching token is always matched as a whole, so the search may start at token starts only.
# That keeps it linear on long tokens without an @ sign.
EMAIL = (
    rf"(?<!{NOT_SPACE}){NOT_SPACE}[^\s\x0B\x1C-\x1F\x85\p{{Z}}@]*@"
    rf"{NOT_SPACE}[^\s\x0B\x1C-\x1F\x85\p{{Z}}.]*\.{NOT_SPACE}+"
)
# Paths are reduced to their file name. A repeated group would recurse once per path segment, and a
# text of some thousand segments would overflow the stack. Doubled separators are therefore parted by
# a mark first; then a path is a run of characters without that mark.
MARK, OPEN, CLOSE = "\uFDD0", "\uFDD1", "\uFDD2"
WINDOWS_PATH = rf'[A-Za-z]:\\(?:[^/:*?"<>|\r\n{MARK}]*\\)?([^\\/:*?"<>|\r\n{MARK}]+)'
# The second branch takes a run without a file name whole, so that no part of it is searched again.
UNIX_PATH = rf"/(?:[^\s{MARK}]*/)?([^/\s{MARK}]+\.[a-zA-Z]+)|(/[^\s{MARK}]*+)"
CODE_BLOCK = r"```[\s\S]*?```"
INLINE_CODE = r"`[^`]+`"
DISALLOWED = r"""[^\p{L}\p{N}_\s.,:;\-()\[\]'"/@#$%&*+=<>?!]"""

MAX_DOMAINS = 5
SHORT_LINE = 10
MIN_CLEAN = 50
MAX_CHARS = 4000


def strip(c: Column) -> Column:
    """Remove every kind of leading and trailing whitespace (`trim` removes spaces only)."""
    return F.regexp_replace(c, rf"^{SPACE}+|(?<!{SPACE}){SPACE}+$", "")


def words(c: Column) -> Column:
    """Whitespace-separated words, without empty ones."""
    return F.filter(F.split(c, SPACE + "+"), lambda w: w != "")


def sentences(c: Column) -> Column:
    return F.split(c, rf"(?<=[.!?]){SPACE}+")


def rich_text(left="sentence_left", mention="mention", right="sentence_right",
              alt_left="context_left", alt_right="context_right") -> Column:
    """Sentence context when a left sentence exists, else the context window."""

    def joined(a: str, b: str) -> Column:
        return F.concat_ws(" ", *[F.coalesce(F.col(c), F.lit("")) for c in (a, mention, b)])

    return F.when(F.length(left) > 0, joined(left, right)).otherwise(joined(alt_left, alt_right))


def rich_text_strict(left="sentence_left", mention="mention", right="sentence_right",
                     alt_left="context_left", alt_right="context_right") -> Column:
    """Like rich_text, but stripped sides, and the window only if both sentence sides are empty."""

    def side(name: str) -> Column:
        return F.nullif(strip(F.col(name)), F.lit(""))

    middle = F.coalesce(F.col(mention), F.lit(""))
    no_sentence = side(left).isNull() & side(right).isNull()
    return strip(
        F.when(no_sentence, F.concat_ws(" ", side(alt_left), middle, side(alt_right)))
        .otherwise(F.concat_ws(" ", side(left), middle, side(right)))
    )


def word_count(c: Column) -> Column:
    return F.size(F.split(c, r"\s+"))


def technique_id(link: Column, pattern: str = TECHNIQUE_PATTERN) -> Column:
    return F.regexp_extract(link, pattern, 1)


def label_or_other(label: Column) -> Column:
    return F.coalesce(F.nullif(label, F.lit("")), F.lit(OTHER))


def fixed_label(label: Column, kept=TOP_TECHNIQUES) -> Column:
    return F.when(label.isin(*kept), label).otherwise(F.lit(OTHER))


def fixed_encoding(label: Column, kept=TOP_TECHNIQUES) -> Column:
    """Index of a label in the sorted fixed set plus OTHER, through a map literal."""
    pairs = [F.lit(x) for i, name in enumerate(sorted({*kept, OTHER})) for x in (name, i)]
    return F.try_element_at(F.create_map(*pairs), label)


def doc_key(name: Column) -> Column:
    return F.lower(strip(F.replace(name, F.lit(".txt"), F.lit(""))))


def negative_to_other(label: Column) -> Column:
    return F.when(label == NO_ANNOTATION, F.lit(OTHER)).otherwise(label)


def file_names(c: Column) -> Column:
    """Windows and Unix paths replaced by their file name between spaces."""
    t = F.translate(c, MARK + OPEN + CLOSE, "   ")
    t = F.regexp_replace(t, r"(?<=\\)(?=\\)", MARK)
    t = F.translate(F.regexp_replace(t, WINDOWS_PATH, " $1 "), MARK, "")
    t = F.regexp_replace(t, r"(?<=/)(?=/)", MARK)
    t = F.regexp_replace(t, UNIX_PATH, f"{OPEN}$1{CLOSE}$2")  # a branch that did not match gives nothing
    return F.translate(F.replace(t, F.lit(OPEN + CLOSE), F.lit("")), OPEN + CLOSE + MARK, "  ")


def clean_text(c: Column) -> Column:
    """Ordered cleaning chain; see the patterns above."""
    t = F.regexp_replace(c, URL, " [URL] ")
    t = F.regexp_replace(t, EMAIL, " [EMAIL] ")
    t = file_names(t)
    t = F.regexp_replace(t, CODE_BLOCK, " [CODE_BLOCK] ")
    t = F.regexp_replace(t, INLINE_CODE, " [CODE] ")
    t = F.regexp_replace(t, DISALLOWED, " ")
    t = F.trim(F.regexp_replace(t, SPACE + "+", " "))
    hosts = F.slice(F.array_distinct(F.regexp_extract_all(c, F.lit(URL_HOST), F.lit(1))), 1, MAX_DOMAINS)

    def with_hosts(s: Column) -> Column:
        body = F.when(F.length(s["t"]) > SHORT_LINE, s["t"]).otherwise(F.lit(""))
        tail = F.when(
            F.size(s["h"]) > 0,
            F.concat(F.lit(" [DOMAINS: "), F.array_join(s["h"], ", "), F.lit("]")),
        ).otherwise(F.lit(""))
        return F.concat(body, tail)

    def safe(t: Column) -> Column:
        too_short = (F.length(F.trim(t)) < MIN_CLEAN) & (F.length(c) > MIN_CLEAN)
        return F.when(too_short, F.substring(t, F.lit(1), F.length(c))).otherwise(F.trim(t))

    full = let(F.struct(t.alias("t"), hosts.alias("h")), with_hosts)
    return F.when(c.isNull(), F.lit("")).otherwise(let(full, safe))


def _whole_word(w: str) -> str:
    return rf"{w}(?<!{WORD_CHAR}{w})(?!{WORD_CHAR})"


def normalize_text(c: Column, straighten_quotes: bool = False) -> Column:
    """Dashes to '-', then each abbreviation followed by its expansion, in fixed order."""
    t = F.translate(F.coalesce(c, F.lit("")), "–—", "--")
    if straighten_quotes:
        t = F.translate(t, "“”‘’", "\"\"''")
    expanded = reduce(
        lambda s, a: F.regexp_replace(s, "(?i)" + _whole_word(a[0]), f"{a[0]} ({a[1]})"), ABBREVIATIONS, t)
    # Most texts hold none of them: one search spares those the replacements.
    any_of = "(?i)" + "|".join(_whole_word(a) for a, _ in ABBREVIATIONS)
    return let(t, lambda x: F.when(x.rlike(any_of), expanded).otherwise(x))


def truncate_head(c: Column, n: int = MAX_CHARS) -> Column:
    return F.substring(c, 1, n)


def truncate_tail(c: Column, n: int = MAX_CHARS) -> Column:
    return F.right(c, F.lit(n))


def truncate_head_tail(c: Column, n: int = MAX_CHARS) -> Column:
    half = n // 2
    both = F.concat(F.substring(c, 1, half), F.lit(" [...] "), F.right(c, F.lit(half)))
    return F.when(F.length(c) <= n, c).otherwise(both)


def truncate_important(c: Column, n: int = MAX_CHARS) -> Column:
    """Sentences by keyword score, stable, up to the first one that does not fit below `n`."""

    def scored(s: Column, i: Column) -> Column:
        low = F.lower(s)
        hits = reduce(lambda a, b: a + b, [F.contains(low, F.lit(k)).cast("int") for k in KEYWORDS])
        return F.struct((-hits).alias("score"), i.alias("pos"), s.alias("s"))

    def step(acc: Column, x: Column) -> Column:
        size = F.length(x["s"])
        fits = acc["open"] & (acc["used"] + size < n)
        text = F.when(acc["kept"] == 0, x["s"]).otherwise(F.concat(acc["text"], F.lit(" "), x["s"]))
        return F.struct(
            F.when(fits, text).otherwise(acc["text"]).alias("text"),
            F.when(fits, acc["used"] + size).otherwise(acc["used"]).alias("used"),
            F.when(fits, acc["kept"] + 1).otherwise(acc["kept"]).alias("kept"),
            fits.alias("open"),
        )

    start = F.struct(F.lit("").alias("text"), F.lit(0).alias("used"), F.lit(0).alias("kept"),
                     F.lit(True).alias("open"))
    ranked = F.array_sort(F.transform(sentences(c), scored))
    chosen = let(
        F.aggregate(ranked, start, step),
        lambda a: F.when(a["kept"] > 0, a["text"]).otherwise(truncate_head(c, n)),
    )
    return F.when(F.length(c) <= n, c).otherwise(chosen)


TRUNCATIONS = {
    "head": truncate_head,
    "tail": truncate_tail,
    "head_tail": truncate_head_tail,
    "important": truncate_important,
}


def preview(c: Column, n: int = 200) -> Column:
    return F.concat(F.substring(c, 1, n), F.lit("..."))


# Words of an explanation, and the bounds above or below which they hold.
UNCERTAINTY = ((1.5, "Very high"), (1.0, "High"))
UNCERTAINTY_ELSE = "Moderate"
MARGINS = ((0.1, "nearly equal top-2 class probabilities"), (0.3, "small margin between top predictions"))
UNCERTAIN, FLIPPED, UNSURE = " uncertainty (entropy=", "attack caused misclassification via ", "low model confidence ("
NO_ATTACK = "unknown"


def _first(cases, otherwise=None) -> Column:
    """The value of the first condition that holds."""
    out = F.lit(otherwise)
    for condition, value in reversed(cases):
        out = F.when(condition, F.lit(value)).otherwise(out)
    return out


def explain_selection(entropy: Column, margin: Column, method: Column, attack: Column,
                      confidence: Column) -> Column:
    """One sentence on why a sample was selected."""
    band = _first([(entropy > x, word) for x, word in UNCERTAINTY], UNCERTAINTY_ELSE)
    flipped = F.concat(F.lit(FLIPPED), F.coalesce(attack, F.lit(NO_ATTACK)))
    unsure = F.concat(F.lit(UNSURE), F.format_string("%.3f", confidence), F.lit(")"))
    return F.concat_ws(
        "; ",
        F.concat(band, F.lit(UNCERTAIN), F.format_string("%.3f", entropy), F.lit(")")),
        _first([(margin < x, words_) for x, words_ in MARGINS]),
        F.when(F.contains(method, F.lit("misclassification")), flipped).when(
            F.contains(method, F.lit("low_confidence")), unsure),
    )
