"""Reproducible text perturbations as column expressions.

Every function takes the text and the row id. Positions and replacements are drawn from
(id, attack, index, seed), so the same row gives the same text on any cluster layout.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from bulwark.functions.seeded import SEED, let, pick, seeded_md5, stratified_draw, uniform
from bulwark.functions.text import SPACE, sentences, words

# Look-alike characters.
HOMOGLYPHS = {
    "a": ["а", "ɑ", "α"],
    "e": ["е", "ε", "ё"],
    "o": ["о", "ο", "ö"],
    "i": ["і", "ι", "ί"],
    "c": ["с", "ϲ"],
    "p": ["р", "ρ"],
    "s": ["ѕ", "ś"],
    "x": ["х", "χ"],
    "y": ["у", "ý"],
    "n": ["η", "ñ"],
}

# Neighbours on a QWERTY keyboard.
KEYBOARD = {
    "q": "wa", "w": "qeas", "e": "wrds", "r": "etdf", "t": "ryfg", "y": "tugh",
    "u": "yihj", "i": "uojk", "o": "iplk", "p": "ol", "a": "qwsz", "s": "awedxz",
    "d": "serfcx", "f": "drtgvc", "g": "ftyhbv", "h": "gyujnb", "j": "huiknm",
    "k": "jiolm", "l": "kop", "z": "asx", "x": "zsdc", "c": "xdfv", "v": "cfgb",
    "b": "vghn", "n": "bhjm", "m": "njk",
}

# Words a synonym attack leaves alone.
STOP_WORDS = (
    "the", "a", "an", "is", "are", "was", "were", "be", "been",
    "being", "have", "has", "had", "do", "does", "did", "will",
    "would", "could", "should", "may", "might", "must", "shall",
)

# Domain synonyms for augmentation.
DOMAIN_SYNONYMS = {
    "attack": ["assault", "offensive", "strike", "intrusion"],
    "malware": ["malicious software", "virus", "threat"],
    "hacker": ["threat actor", "adversary", "attacker"],
    "steal": ["exfiltrate", "extract", "harvest"],
    "install": ["deploy", "drop", "plant"],
    "execute": ["run", "launch", "invoke"],
    "target": ["victim", "objective", "focus"],
    "spread": ["propagate", "distribute", "disseminate"],
    "hide": ["conceal", "obfuscate", "mask"],
    "detect": ["identify", "discover", "find"],
}

# Words that random deletion preserves.
PRESERVED = (
    "malware", "attack", "threat", "vulnerability", "exploit",
    "backdoor", "trojan", "ransomware", "phishing", "apt",
    "command", "control", "execute", "payload", "persistence",
)

ALPHABET = "abcdefghijklmnopqrstuvwxyz"
EDGE_MARKS = r"^[.,!?;:]+|[.,!?;:]+$"

# Characters per block when places in a text are counted.
BLOCK = 256
# Characters at the start of a text where its first words are looked for.
HEAD = 512


def literal_map(table: dict) -> Column:
    """A map literal for the small fixed tables above."""
    cells = []
    for key, value in table.items():
        cells.append(F.lit(key))
        cells.append(F.array(*map(F.lit, value)) if isinstance(value, list) else F.lit(value))
    return F.create_map(*cells)


def _tag(name: str, i: Column) -> Column:
    return F.concat(F.lit(name + "-"), i.cast("string"))


def one_line(text: Column) -> Column:
    """The text with whitespace collapsed, behind one space. Single spaces are left alone, as most are."""
    runs = rf"[{SPACE}&&[^ ]]{SPACE}*+| {SPACE}++"
    return F.concat(F.lit(" "), F.trim(F.regexp_replace(text, runs, " ")))


def word_starts(line: Column, eligible: str, limit: int = -1) -> Column:
    """A text on one line, cut in front of every word that matches `eligible`.

    The first piece is what comes before the first such word; every further piece starts with one.
    One regular expression finds the words, so no piece is built for the others.
    """
    return F.split(line, rf"(?<= )(?={eligible}(?![^ ]))", limit)


def first_word(piece: Column) -> Column:
    return F.substring_index(piece, " ", 1)


def without_margin(line: Column) -> Column:
    """A text on one line without the space in front."""
    return let(line, lambda t: F.substring(t, F.lit(2), F.length(t)))


def join_pieces(pieces: Column, new_word) -> Column:
    """Put the pieces of a line together again; `new_word(word, rank)` replaces a word unless it is NULL."""

    def changed(piece: Column, k: Column) -> Column:
        old = first_word(piece)
        new = new_word(old, k - 1)
        return F.when(k > 0, F.coalesce(
            F.concat(new, F.substring(piece, F.length(old) + 1, F.length(piece))), piece)).otherwise(piece)

    return F.array_join(F.transform(pieces, changed), "")


def noise_mix(text: Column, row_id: Column, level: float = 0.15, seed: int = SEED) -> Column:
    """A share `level` of rows loses its vowels, the next share has its long words doubled."""

    def mixed(u: Column) -> Column:
        return (
            F.when(u < level, F.regexp_replace(text, "[aeiou]", ""))
            .when(u < 2 * level, F.regexp_replace(text, r"([\p{L}\p{N}_]{4,})", "$1$1"))
            .otherwise(text)
        )

    return let(uniform(row_id, "mix", seed), mixed)


def _blocks(text: Column, overlap: int) -> Column:
    """The text in pieces of BLOCK characters, each with `overlap` characters of the next one, in one pass."""
    ahead = f"(?=(.{{1,{BLOCK + overlap}}}+))" if overlap else ""
    pieces = F.regexp_extract_all(text, F.lit(f"(?s){ahead}.{{1,{BLOCK}}}+"), F.lit(1 if overlap else 0))
    return F.when(text == "", F.array(F.lit(""))).otherwise(pieces)


def _edit_places(text: Column, row_id: Column, name: str, n: int, seed: int, runs: str, filler: str,
                 cut: str, edit) -> Column:
    """Apply `edit(current text, place, rank)` at `n` drawn places; a place is a position from 1.

    The places of a block number length(block) - length(block with each run replaced by `filler`),
    so one pass over the text counts them all. Only blocks that hold a drawn place are `cut` into
    single places.
    """
    overlap = len(filler)

    def with_counts(blocks: Column) -> Column:
        counts = F.transform(blocks, lambda b: F.length(b) - F.length(F.regexp_replace(b, runs, filler)))
        return F.struct(blocks.alias("blocks"), counts.alias("counts"))

    def place(b: Column, rank: Column) -> Column:
        start = F.struct(rank.alias("left"), F.lit(0).alias("block"), F.lit(False).alias("found"))

        def look(acc: Column, k: Column) -> Column:
            found = acc["found"] | (acc["left"] < k)
            return F.struct(
                F.when(found, acc["left"]).otherwise(acc["left"] - k).alias("left"),
                F.when(found, acc["block"]).otherwise(acc["block"] + 1).alias("block"),
                found.alias("found"),
            )

        def inside(at: Column) -> Column:
            pieces = F.split(F.get(b["blocks"], at["block"]), cut, at["left"] + 2)
            head = F.aggregate(F.slice(pieces, F.lit(1), at["left"] + 1), F.lit(0), lambda a, x: a + F.length(x))
            return at["block"] * BLOCK + head

        return let(F.aggregate(b["counts"], start, look), inside)

    def edited(b: Column) -> Column:
        total = F.aggregate(b["counts"], F.lit(0), lambda a, k: a + k)
        drawn = stratified_draw(row_id, name, total, n, seed)
        return F.aggregate(
            drawn, text, lambda t, rank: let(place(b, rank), lambda p: edit(t, p, rank)))

    return let(let(_blocks(text, overlap), with_counts), edited)


def char_swap(text: Column, row_id: Column, n: int = 2, seed: int = SEED) -> Column:
    """Swap `n` pairs of neighbouring letters."""

    def swap(t: Column, p: Column, rank: Column) -> Column:
        return F.overlay(t, F.reverse(F.substring(t, p, F.lit(2))), p, F.lit(2))

    # A run of k letters holds k - 1 pairs; a pair may reach into the next block.
    return _edit_places(text, row_id, "swap", n, seed, r"\p{L}++", ".", r"(?<=\p{L})(?=\p{L})", swap)


def _replace_chars(text: Column, row_id: Column, name: str, chars: str, n: int, seed: int, new_char):
    """Replace `n` characters of a class."""

    def replace(t: Column, p: Column, rank: Column) -> Column:
        return F.overlay(t, new_char(F.substring(t, p, F.lit(1)), rank), p, F.lit(1))

    return _edit_places(text, row_id, name, n, seed, f"[{chars}]++", "", f"(?<=[{chars}])", replace)


def homoglyph(text: Column, row_id: Column, n: int = 3, seed: int = SEED) -> Column:
    """Replace `n` characters by look-alikes; the result is lower case."""
    table = literal_map(HOMOGLYPHS)
    keys = "".join(HOMOGLYPHS)

    def new_char(ch: Column, i: Column) -> Column:
        return let(
            F.try_element_at(table, F.lower(ch)),
            lambda options: F.get(options, pick(row_id, _tag("glyph", i), F.size(options), seed)),
        )

    return _replace_chars(text, row_id, "homoglyph", keys + keys.upper(), n, seed, new_char)


def keyboard_typo(text: Column, row_id: Column, n: int = 2, seed: int = SEED) -> Column:
    """Replace `n` letters by a keyboard neighbour of the same case."""
    table = literal_map(KEYBOARD)

    def new_char(ch: Column, i: Column) -> Column:
        def chosen(options: Column) -> Column:
            at = pick(row_id, _tag("key", i), F.length(options), seed)
            new = F.substring(options, at + 1, F.lit(1))
            return F.when(ch == F.lower(ch), new).otherwise(F.upper(new))

        return let(F.try_element_at(table, F.lower(ch)), chosen)

    return _replace_chars(text, row_id, "keyboard", "a-zA-Z", n, seed, new_char)


def letters(min_len: int) -> str:
    return rf"\p{{L}}{{{min_len},}}+"


# Words a synonym attack may touch.
REPLACEABLE = rf"(?!(?i:{'|'.join(STOP_WORDS)})(?![^ ]))" + letters(4)


def _edit_first(line: Column, eligible: str, n: int, new_word) -> Column:
    return join_pieces(word_starts(line, eligible, n + 1), new_word)


def first_starts(line: Column, eligible: str, n: int, head: int = HEAD) -> Column:
    """word_starts with limit n + 1; a line whose head holds n + 1 eligible words is not searched to its end.

    A split with a limit goes on searching. Only the head's last word may be cut off, so n words in front of one are whole.
    """

    def found(t: Column) -> Column:
        def whole(p: Column) -> Column:
            last = F.concat(F.get(p, F.lit(n)), F.get(p, F.lit(n + 1)), F.substring(t, F.lit(head + 1), F.length(t)))
            return F.when(F.size(p) == n + 2, F.concat(F.slice(p, 1, n), F.array(last))).otherwise(word_starts(t, eligible, n + 1))

        return let(word_starts(F.substring(t, 1, head), eligible, n + 2), whole)

    return let(line, found)


def char_delete(text: Column, row_id: Column, n: int = 2, min_len: int = 5, seed: int = SEED, line: Column | None = None) -> Column:
    """Delete one inner character in each of the first `n` alphabetic words of `min_len` or more."""
    return without_margin(delete_in_line(one_line(text) if line is None else line, row_id, n, min_len, seed))


def delete_in_line(line: Column, row_id: Column, n: int, min_len: int, seed: int) -> Column:

    def shorter(w: Column, rank: Column) -> Column:
        at = pick(row_id, _tag("delete", rank), F.length(w) - 2, seed) + 1
        return F.concat(F.substring(w, F.lit(1), at), F.substring(w, at + 2, F.length(w)))

    return join_pieces(first_starts(line, letters(min_len), n), shorter)


def char_insert(text: Column, row_id: Column, n: int = 2, min_len: int = 4, seed: int = SEED, line: Column | None = None) -> Column:
    """Insert one letter into each of the first `n` alphabetic words of `min_len` or more."""
    return without_margin(insert_in_line(one_line(text) if line is None else line, row_id, n, min_len, seed))


def insert_in_line(line: Column, row_id: Column, n: int, min_len: int, seed: int) -> Column:

    def longer(w: Column, rank: Column) -> Column:
        at = pick(row_id, _tag("insert", rank), F.length(w) - 1, seed) + 1
        letter = F.substring(F.lit(ALPHABET), pick(row_id, _tag("letter", rank), 26, seed) + 1, F.lit(1))
        return F.concat(F.substring(w, F.lit(1), at), letter, F.substring(w, at + 1, F.length(w)))

    return join_pieces(first_starts(line, letters(min_len), n), longer)


def same_case(new: Column, old: Column) -> Column:
    """Capitalise the replacement of a capitalised word."""
    first = F.substring(old, 1, 1)
    capital = F.concat(F.upper(F.substring(new, 1, 1)), F.lower(F.substring(new, F.lit(2), F.length(new))))
    return F.when((F.upper(first) == first) & (F.lower(first) != first), capital).otherwise(new)


def chosen_ranks(pieces: Column, row_id: Column, n: int, seed: int) -> Column:
    """Which of the replaceable words a synonym attack picks."""
    return stratified_draw(row_id, "synonym", F.size(pieces) - 1, n, seed)


def chosen_synonym(options: Column, word: Column, row_id: Column, rank: Column, seed: int) -> Column:
    one = F.get(options, pick(row_id, _tag("word", rank), F.size(options), seed))
    return F.when(F.size(options) > 0, same_case(one, word))


def is_replaceable(word: Column) -> Column:
    """Whether a synonym attack may touch this word."""
    return word.rlike(rf"\A{REPLACEABLE}\z")


def synonym_script(text: Column, row_id: Column, draws: tuple[int, ...], seed: int = SEED) -> Column:
    """Which words synonym attacks of these sizes replace: array of (n, rank, place, word), from one cut of the text.

    The place counts from 0 in the text on one line. With it an attack needs no cut of its own.
    """

    def entries(pieces: Column) -> Column:
        def chosen(n: int) -> Column:
            def entry(rank: Column) -> Column:
                place = F.aggregate(F.slice(pieces, F.lit(1), (rank + 1).cast("int")), F.lit(0), lambda a, p: a + F.length(p))
                word = first_word(F.get(pieces, (rank + 1).cast("int")))
                return F.struct(F.lit(n).alias("n"), rank.cast("int").alias("rank"), place.alias("place"), word.alias("word"))

            return F.transform(chosen_ranks(pieces, row_id, n, seed), entry)

        return F.flatten(F.array(*map(chosen, draws)))

    return let(word_starts(one_line(text), REPLACEABLE), entries)


def synonym(text: Column, row_id: Column, synonyms: Column, script: Column, n: int = 3, seed: int = SEED,
            line: Column | None = None) -> Column:
    """Replace `n` words by synonyms from a map<word, array<synonym>> column; both come from operators.corpus.with_synonym_map."""
    new = without_margin(synonym_in_line(one_line(text) if line is None else line, row_id, synonyms, script, n, seed))
    return F.when(F.exists(script, lambda e: e["n"] == n), new).otherwise(text)


def synonym_in_line(line: Column, row_id: Column, synonyms: Column, script: Column, n: int, seed: int) -> Column:

    def replaced(t: Column, e: Column) -> Column:
        options = F.try_element_at(synonyms, F.lower(e["word"]))
        new = let(options, lambda found: chosen_synonym(found, e["word"], row_id, e["rank"], seed))
        rest = F.substring(t, e["place"] + F.length(e["word"]) + 1, F.length(t))
        return let(new, lambda w: F.coalesce(F.concat(F.substring(t, F.lit(1), e["place"]), w, rest), t))

    def apply(edits: Column) -> Column:
        last_first = F.reverse(F.array_sort(F.transform(edits, lambda e: F.struct(e["place"].alias("place"), e["rank"].alias("rank"), e["word"].alias("word")))))
        return F.aggregate(last_first, line, replaced)

    return let(F.filter(script, lambda e: e["n"] == n), apply)


def combined(text: Column, row_id: Column, synonyms: Column, script: Column, seed: int = SEED, line: Column | None = None) -> Column:
    """All attacks in a row, with the strong settings.

    The text is put on one line first: edits of letters count letters, so blanks don't move them.
    """
    steps = (
        lambda t: F.coalesce(synonym_in_line(t, row_id, synonyms, script, 8, seed), t),  # a row without id has no script
        lambda t: char_swap(t, row_id, 5, seed),
        lambda t: keyboard_typo(t, row_id, 4, seed),
        lambda t: homoglyph(t, row_id, 5, seed),
        lambda t: delete_in_line(t, row_id, 3, 5, seed),
        lambda t: insert_in_line(t, row_id, 3, 4, seed),
    )
    return without_margin(reduce(lambda t, step: let(t, step), steps, one_line(text) if line is None else line))


def random_choice(text: Column, row_id: Column, synonyms: Column, script: Column, seed: int = SEED, line: Column | None = None) -> Column:
    """One of four attacks, drawn per row."""
    return chosen_text(row_id, {
        "synonym": synonym(text, row_id, synonyms, script, seed=seed, line=line), "char_swap": char_swap(text, row_id, seed=seed),
        "keyboard_typo": keyboard_typo(text, row_id, seed=seed), "homoglyph": homoglyph(text, row_id, seed=seed)}, seed)


# The attacks of random_choice, in the order they are drawn by.
CHOICES = ("synonym", "char_swap", "keyboard_typo", "homoglyph")


def chosen_text(row_id: Column, texts: dict[str, Column], seed: int = SEED) -> Column:
    """The text under one of CHOICES, drawn per row."""
    first, second, third, last = (texts[name] for name in CHOICES)
    return let(
        pick(row_id, "choice", 4, seed),
        lambda k: F.when(k == 0, first).when(k == 1, second).when(k == 2, third).otherwise(last))


def attack_suite(text: Column, row_id: Column, synonyms: Column, script: Column, seed: int = SEED,
                 line: Column | None = None) -> dict[str, Column]:
    """Attacks by name, in suite order. `line` is a column with one_line(text), which most of them start from."""
    return {
        "synonym": synonym(text, row_id, synonyms, script, seed=seed, line=line),
        "char_swap": char_swap(text, row_id, seed=seed),
        "homoglyph": homoglyph(text, row_id, seed=seed),
        "keyboard_typo": keyboard_typo(text, row_id, seed=seed),
        "char_deletion": char_delete(text, row_id, seed=seed, line=line),
        "char_insertion": char_insert(text, row_id, seed=seed, line=line),
        "combined": combined(text, row_id, synonyms, script, seed, line),
        "random": random_choice(text, row_id, synonyms, script, seed, line),
    }


def augment_synonym(text: Column, row_id: Column, n: int = 3, seed: int = SEED) -> Column:
    """Replace the first `n` words of the domain dictionary; marks around them are lost.

    No replacement is itself a dictionary word, so `n` passes over the text equal one.
    """
    table = literal_map(DOMAIN_SYNONYMS)

    def new_word(w: Column, rank: Column) -> Column:
        return let(
            F.try_element_at(table, F.regexp_replace(F.lower(w), EDGE_MARKS, "")),
            lambda options: F.get(options, pick(row_id, _tag("augment", rank), F.size(options), seed)),
        )

    return without_margin(_edit_first(one_line(text), rf"[.,!?;:]*+(?i:{'|'.join(DOMAIN_SYNONYMS)})[.,!?;:]*+", n, new_word))


def augment_delete(text: Column, row_id: Column, p: float = 0.1, seed: int = SEED) -> Column:
    """Drop words with probability `p`, never the preserved ones; short texts stay as they are."""

    def body(ws: Column) -> Column:
        kept = F.filter(
            ws, lambda w, i: F.lower(w).isin(*PRESERVED) | (uniform(row_id, _tag("drop", i), seed) > p)
        )
        joined = let(kept, lambda k: F.when(F.size(k) > 0, F.array_join(k, " ")).otherwise(text))
        return F.when(F.size(ws) <= 10, text).otherwise(joined)

    return let(words(text), body)


def augment_shuffle(text: Column, row_id: Column, seed: int = SEED) -> Column:
    """Permute the inner sentences; the first and the last keep their place."""

    def body(ss: Column) -> Column:
        inner = F.slice(ss, F.lit(2), F.greatest(F.size(ss) - 2, F.lit(0)))
        keyed = F.transform(
            inner,
            lambda s, i: F.struct(seeded_md5(row_id, _tag("order", i), seed).alias("h"), i.alias("i"), s.alias("s")),
        )
        mixed = F.transform(F.array_sort(keyed), lambda x: x["s"])
        ends = F.concat(F.slice(ss, 1, 1), mixed, F.slice(ss, -1, 1))
        return F.when(F.size(ss) <= 3, text).otherwise(F.array_join(ends, " "))

    return let(sentences(text), body)


def augment_random(text: Column, row_id: Column, copy=0, seed: int = SEED) -> Column:
    """One of the three augmentations, drawn per (row, copy)."""
    copy_id = F.concat_ws("/", row_id.cast("string"), copy if isinstance(copy, Column) else F.lit(str(copy)))
    return let(
        pick(copy_id, "augmentation", 3, seed),
        lambda k: F.when(k == 0, augment_synonym(text, copy_id, seed=seed))
        .when(k == 1, augment_delete(text, copy_id, seed=seed))
        .otherwise(augment_shuffle(text, copy_id, seed)),
    )
