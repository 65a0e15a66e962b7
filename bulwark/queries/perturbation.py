"""Text perturbations (X)."""

from pyspark.sql import functions as F

from bulwark.functions import perturb
from bulwark.operators import corpus
from bulwark.queries import views
from bulwark.queries.registry import query
from bulwark.queries.views import u_sql

SP = r"[\s\x0B\x1C-\x1F\x85\p{Z}]"
WORDS = f"list_filter(regexp_split_to_array(t, '{SP}+'), lambda w: w <> '')"


def quoted(names):
    return ", ".join(f"'{n}'" for n in names)


def draw_sql(tag, m, n):
    """Stratified positions, as functions.seeded.stratified_draw."""
    k = f"least({n}, {m})"
    u = u_sql("rid", f"concat('{tag}-', k)")
    return (f"[(k * {m} // {k} + floor({u} * ((k + 1) * {m} // {k} - k * {m} // {k}))::BIGINT)::BIGINT "
            f"FOR k IN range(0, {k})]")


def pick_sql(tag, i, size):
    return f"floor({u_sql('rid', f'concat({chr(39)}{tag}-{chr(39)}, {i})')} * {size})::BIGINT"


# Each generator reads (doc_id, rid, t) from a view and gives the same columns, t perturbed.


def swap_sql(src, n=2):
    swap = ("concat(left(a, p::BIGINT - 1), substring(a, p::BIGINT + 1, 1), substring(a, p::BIGINT, 1), "
            "substring(a, p::BIGINT + 2))")
    return rf"""
    WITH c AS (SELECT doc_id, rid, t, [regexp_matches(x, '^\p{{L}}$') FOR x IN string_split(t, '')] AS l FROM {src}),
         q AS (SELECT doc_id, rid, t, [i FOR i IN range(1, len(l)) IF l[i] AND l[i + 1]] AS pairs FROM c),
         d AS (SELECT doc_id, rid, t, pairs, {draw_sql('swap', 'len(pairs)', n)} AS drawn FROM q)
    SELECT doc_id, rid, list_reduce([pairs[j + 1]::VARCHAR FOR j IN drawn], lambda a, p: {swap}, t) AS t FROM d"""


def _chars_sql(src, tag, chars, n, new_char):
    return f"""
    WITH s AS (SELECT doc_id, rid, t, regexp_extract_all(t, '[^{chars}]*[{chars}]') AS segs FROM {src}),
         d AS (SELECT *, {draw_sql(tag, 'len(segs)', n)} AS drawn,
                      substring(t, 1 + coalesce(list_sum([length(x) FOR x IN segs]), 0)::BIGINT) AS tail FROM s)
    SELECT doc_id, rid, concat(array_to_string(list_transform(segs, lambda s, i:
             CASE WHEN list_contains(drawn, i - 1) THEN concat(left(s, length(s) - 1), {new_char}) ELSE s END), ''),
             tail) AS t FROM d"""


def homoglyph_sql(src, n=3):
    keys = "".join(perturb.HOMOGLYPHS)
    cases = " ".join(f"WHEN '{k}' THEN [{quoted(v)}]" for k, v in perturb.HOMOGLYPHS.items())
    sizes = " ".join(f"WHEN '{k}' THEN {len(v)}" for k, v in perturb.HOMOGLYPHS.items())
    ch = "lower(right(s, 1))"
    new = f"(CASE {ch} {cases} END)[{pick_sql('glyph', 'i - 1', f'(CASE {ch} {sizes} END)')} + 1]"
    return _chars_sql(src, "homoglyph", keys + keys.upper(), n, new)


def keyboard_sql(src, n=2):
    cases = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in perturb.KEYBOARD.items())
    options = f"(CASE lower(right(s, 1)) {cases} END)"
    one = f"substring({options}, {pick_sql('key', 'i - 1', f'length{options}')} + 1, 1)"
    new = f"CASE WHEN right(s, 1) = lower(right(s, 1)) THEN {one} ELSE upper({one}) END"
    return _chars_sql(src, "keyboard", "a-zA-Z", n, new)


def _words_sql(src, n, min_len, new_word):
    return rf"""
    WITH w AS (SELECT doc_id, rid, {WORDS} AS ws FROM {src}),
         e AS (SELECT *, [i FOR i IN range(1, len(ws) + 1)
                          IF length(ws[i]) >= {min_len} AND regexp_full_match(ws[i], '\p{{L}}+')][1:{n}] AS targets FROM w)
    SELECT doc_id, rid, array_to_string(list_transform(ws, lambda w, i:
             CASE WHEN list_contains(targets, i) THEN {new_word} ELSE w END), ' ') AS t FROM e"""


def delete_sql(src, n=2):
    at = f"({pick_sql('delete', 'list_position(targets, i) - 1', '(length(w) - 2)')} + 1)"
    return _words_sql(src, n, 5, f"concat(left(w, {at}), substring(w, {at} + 2))")


def insert_sql(src, n=2):
    at = f"({pick_sql('insert', 'list_position(targets, i) - 1', '(length(w) - 1)')} + 1)"
    letter = f"substring('{perturb.ALPHABET}', {pick_sql('letter', 'list_position(targets, i) - 1', '26')} + 1, 1)"
    return _words_sql(src, n, 4, f"concat(left(w, {at}), {letter}, substring(w, {at} + 1))")


_REPLACEABLE = (rf"length(x) >= 4 AND regexp_full_match(x, '\p{{L}}+') AND lower(x) NOT IN ({quoted(perturb.STOP_WORDS)})")


def synonym_sql(src, n=3):
    options = "map_extract(syn, i)[1]"
    one = f"({options})[{pick_sql('word', 'list_position(elig, i) - 1', f'len({options})')} + 1]"
    capital = f"concat(upper({one}[1]), lower(substring({one}, 2)))"
    old = "upper(w[1]) = w[1] AND lower(w[1]) <> w[1]"
    return rf"""
    WITH w AS (SELECT doc_id, rid, t, {WORDS} AS ws FROM {src}),
         e AS (SELECT *, list_filter(range(1, len(ws) + 1), lambda j: {_REPLACEABLE.replace('x', 'ws[j]').replace('rege' + 'ws[j]' + 'p', 'regexp')}) AS elig
               FROM w),
         d AS (SELECT *, {draw_sql('synonym', 'len(elig)', n)} AS drawn FROM e),
         g AS (SELECT *, [elig[j + 1] FOR j IN drawn] AS targets FROM d),
         c AS (SELECT doc_id, i, lower(ws[i]) AS word FROM (SELECT doc_id, ws, unnest(targets) AS i FROM g)),
         f AS (SELECT doc_id, map_from_entries(list((i, synonyms))) AS syn FROM c JOIN v_synonyms USING (word) GROUP BY doc_id),
         x AS (SELECT g.*, f.syn FROM g LEFT JOIN f USING (doc_id))
    SELECT doc_id, rid, CASE WHEN len(targets) = 0 THEN t ELSE array_to_string(list_transform(ws, lambda w, i:
             CASE WHEN list_contains(targets, i) AND {options} IS NOT NULL
                  THEN CASE WHEN {old} THEN {capital} ELSE {one} END ELSE w END), ' ') END AS t FROM x"""


def augment_synonym_sql(src, n=3):
    bare = "regexp_replace(lower({0}), '^[.,!?;:]+|[.,!?;:]+$', '', 'g')"
    cases = " ".join(f"WHEN '{k}' THEN [{quoted(v)}]" for k, v in perturb.DOMAIN_SYNONYMS.items())
    options = f"(CASE {bare.format('w')} {cases} END)"
    return f"""
    WITH w AS (SELECT doc_id, rid, {WORDS} AS ws FROM {src}),
         e AS (SELECT *, [i FOR i IN range(1, len(ws) + 1) IF {bare.format('ws[i]')} IN ({quoted(perturb.DOMAIN_SYNONYMS)})][1:{n}]
                         AS targets FROM w)
    SELECT doc_id, rid, array_to_string(list_transform(ws, lambda w, i:
             CASE WHEN list_contains(targets, i) THEN {options}[{pick_sql('augment', 'list_position(targets, i) - 1', f'len({options})')} + 1]
                  ELSE w END), ' ') AS t FROM e"""


def augment_delete_sql(src):
    u = u_sql("rid", "concat('drop-', i - 1)")
    return f"""
    WITH w AS (SELECT doc_id, rid, t, {WORDS} AS ws FROM {src}),
         k AS (SELECT *, list_filter(ws, lambda w, i: lower(w) IN ({quoted(perturb.PRESERVED)}) OR {u} > 0.1) AS kept FROM w)
    SELECT doc_id, rid, CASE WHEN len(ws) <= 10 OR len(kept) = 0 THEN t ELSE array_to_string(kept, ' ') END AS t FROM k"""


def augment_shuffle_sql(src):
    return rf"""
    WITH s AS (SELECT doc_id, rid, t,
                 string_split(regexp_replace(t, '([.!?]){SP}+', concat('\1', chr(1)), 'g'), chr(1)) AS ss FROM {src}),
         m AS (SELECT *, list_sort(list_transform(ss[2:len(ss) - 1], lambda x, i:
                 {{'h': md5(concat_ws(':', rid, concat('order-', i - 1), 42)), 'i': i, 's': x}})) AS mid FROM s)
    SELECT doc_id, rid, CASE WHEN len(ss) <= 3 THEN t
             ELSE array_to_string(list_concat(list_concat(ss[1:1], [x.s FOR x IN mid]), ss[len(ss):len(ss)]), ' ') END AS t
    FROM m"""


views.SQL["v_text"] = "SELECT doc_id, doc_id::VARCHAR AS rid, full_text AS t FROM v_docs"
views.SQL["v_copy_text"] = "SELECT doc_id, concat(doc_id, '/1') AS rid, full_text AS t FROM v_docs"
_TOKENS = f"SELECT unnest({WORDS}) AS x FROM v_text"
views.SQL["v_synonyms"] = f"""
    WITH w AS (SELECT DISTINCT lower(x) AS word FROM ({_TOKENS}) WHERE {_REPLACEABLE}),
         r AS (SELECT word, substr(md5(word), 1, 3) AS part,
                      row_number() OVER (PARTITION BY substr(md5(word), 1, 3) ORDER BY word) - 1 AS r FROM w)
    SELECT a.word, list(b.word ORDER BY b.r) AS synonyms
    FROM r a JOIN r b ON a.part = b.part AND a.r // 4 = b.r // 4 AND a.r <> b.r GROUP BY a.word"""
views.SQL["v_x_synonym"] = synonym_sql("v_text")
views.SQL["v_x_char_swap"] = swap_sql("v_text")
views.SQL["v_x_homoglyph"] = homoglyph_sql("v_text")
views.SQL["v_x_keyboard_typo"] = keyboard_sql("v_text")
views.SQL["v_x_char_deletion"] = delete_sql("v_text")
views.SQL["v_x_char_insertion"] = insert_sql("v_text")
views.SQL["v_c1"] = synonym_sql("v_text", 8)
views.SQL["v_c2"] = swap_sql("v_c1", 5)
views.SQL["v_c3"] = keyboard_sql("v_c2", 4)
views.SQL["v_c4"] = homoglyph_sql("v_c3", 5)
views.SQL["v_c5"] = delete_sql("v_c4", 3)
views.SQL["v_x_combined"] = insert_sql("v_c5", 3)
_K4 = f"floor({u_sql('doc_id', chr(39) + 'choice' + chr(39))} * 4)"
views.SQL["v_x_random"] = f"""
    SELECT doc_id, rid, t FROM v_x_synonym WHERE {_K4} = 0 UNION ALL SELECT doc_id, rid, t FROM v_x_char_swap WHERE {_K4} = 1
    UNION ALL SELECT doc_id, rid, t FROM v_x_keyboard_typo WHERE {_K4} = 2
    UNION ALL SELECT doc_id, rid, t FROM v_x_homoglyph WHERE {_K4} = 3"""
views.SQL["v_a_synonym"] = augment_synonym_sql("v_copy_text")
views.SQL["v_a_delete"] = augment_delete_sql("v_copy_text")
views.SQL["v_a_shuffle"] = augment_shuffle_sql("v_copy_text")


texts = views.texts


def dictionary(spark, sf):
    return corpus.word_groups(texts(spark, sf), "full_text")


def text():
    return F.col("full_text")


def row_id():
    return F.col("doc_id")


_MIX = u_sql("doc_id", "'mix'")


@query("perturb_corpus_mix", rf"""
    SELECT doc_id, CASE WHEN {_MIX} < 0.15 THEN regexp_replace(full_text, '[aeiou]', '', 'g')
                        WHEN {_MIX} < 0.3 THEN regexp_replace(full_text, '([\p{{L}}\p{{N}}_]{{4,}})', '\1\1', 'g')
                        ELSE full_text END AS adv_text FROM v_docs""")
def perturb_corpus_mix(spark, sf):
    return texts(spark, sf).select("doc_id", perturb.noise_mix(text(), row_id()).alias("adv_text"))


def _simple(name, view, column):
    @query(name, f"SELECT doc_id, t AS adv_text FROM {view}")
    def run(spark, sf):
        return texts(spark, sf).select("doc_id", column().alias("adv_text"))


_simple("perturb_char_swap", "v_x_char_swap", lambda: perturb.char_swap(text(), row_id()))
_simple("perturb_homoglyph", "v_x_homoglyph", lambda: perturb.homoglyph(text(), row_id()))
_simple("perturb_keyboard", "v_x_keyboard_typo", lambda: perturb.keyboard_typo(text(), row_id()))
_simple("perturb_delete", "v_x_char_deletion", lambda: perturb.char_delete(text(), row_id()))
_simple("perturb_insert", "v_x_char_insertion", lambda: perturb.char_insert(text(), row_id()))


@query("perturb_synonym", "SELECT doc_id, t AS adv_text FROM v_x_synonym")
def perturb_synonym(spark, sf):
    return corpus.synonym_attack(texts(spark, sf), "doc_id", "full_text", dictionary(spark, sf)).drop("full_text")


@query("perturb_combined", "SELECT doc_id, t AS adv_text FROM v_x_combined")
def perturb_combined(spark, sf):
    d = corpus.with_synonym_map(texts(spark, sf), "doc_id", "full_text", dictionary(spark, sf))
    return d.select("doc_id", perturb.combined(text(), row_id(), F.col("_synonyms"), F.col("_script")).alias("adv_text"))


@query("perturb_random_choice", "SELECT doc_id, t AS adv_text FROM v_x_random")
def perturb_random_choice(spark, sf):
    d = corpus.with_synonym_map(texts(spark, sf), "doc_id", "full_text", dictionary(spark, sf))
    return d.select("doc_id", perturb.random_choice(text(), row_id(), F.col("_synonyms"), F.col("_script")).alias("adv_text"))



def copy_id():
    return F.concat_ws("/", F.col("doc_id").cast("string"), F.lit("1"))


_simple("augment_synonym", "v_a_synonym", lambda: perturb.augment_synonym(text(), copy_id()))
_simple("augment_delete", "v_a_delete", lambda: perturb.augment_delete(text(), copy_id()))
_simple("augment_shuffle", "v_a_shuffle", lambda: perturb.augment_shuffle(text(), copy_id()))

_K3 = f"floor({u_sql('rid', chr(39) + 'augmentation' + chr(39))} * 3)"


@query("augment_random", f"""
    SELECT doc_id, t AS adv_text FROM v_a_synonym WHERE {_K3} = 0
    UNION ALL SELECT doc_id, t FROM v_a_delete WHERE {_K3} = 1
    UNION ALL SELECT doc_id, t FROM v_a_shuffle WHERE {_K3} = 2""")
def augment_random(spark, sf):
    return texts(spark, sf).select("doc_id", perturb.augment_random(text(), row_id(), 1).alias("adv_text"))


_SUITE = ("synonym", "char_swap", "homoglyph", "keyboard_typo", "char_deletion", "char_insertion", "combined", "random")


@query("attack_suite", " UNION ALL ".join(
    f"SELECT doc_id, '{a}' AS attack, {i} AS attack_order, t AS adv_text FROM v_x_{a}" for i, a in enumerate(_SUITE)))
def attack_suite(spark, sf):
    """Every document under every attack, from one scan."""
    d = corpus.with_synonym_map(texts(spark, sf), "doc_id", "full_text", dictionary(spark, sf)).withColumn("_line", perturb.one_line(text()))
    suite = perturb.attack_suite(text(), row_id(), F.col("_synonyms"), F.col("_script"), line=F.col("_line"))
    return corpus.perturb_corpus(d, "doc_id", suite)
