"""The operators of this subpackage bound to the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bulwark.llm import chat, contentsort, decontaminate, htmltext, language, lexical, mixing, neardup, secrets, sharding, topk, urls, whitening

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql:
            SQL[name] = sql.strip()
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def crc(value: Column) -> Column:
    return F.crc32(value.cast("binary"))


@query("op1_sampled_splitters")
def sampled_splitters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's shard of 16 and its place there, by law `bytes`."""
    docs = table(spark, sf_dir, "documents")
    narrow = docs.select(
        "doc_id", sharding.text_size(F.col("text")).alias("size"), crc(F.col("text")).alias("text_crc32"),
        F.xxhash64("text").alias("text_hash"),
    )
    placed = sharding.range_shards(narrow, F.col("text_hash"), F.xxhash64("doc_id"), F.col("size"), shards=16)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


@query(
    "op2_topk_block_pruning",
    """
    WITH v AS (
      SELECT vec_id, [CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS e FROM embeddings
      WHERE embedding IS NOT NULL AND NOT list_contains([x IS NULL OR NOT isfinite(x) FOR x IN embedding], true)),
    s AS (
      SELECT q.vec_id AS query_id, d.vec_id, CAST(list_sum([q.e[i] * d.e[i] FOR i IN range(1, len(q.e) + 1)]) AS BIGINT) AS score
      FROM v q JOIN v d ON q.vec_id <> d.vec_id WHERE q.vec_id % 20 = 0),
    r AS (SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank, vec_id, score FROM s)
    SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 20
    """,
)
def topk_block_pruning(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 best other vectors of every vector whose id is divisible by 20."""
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


URL_RULES = [
    ("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"), ("block", "net", "/fr/"),
]


def url_sql() -> str:
    """The same in SQL: rules, links, parent domains, and one step for each round of the ranks."""
    fits = [f"(host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}')" for _, h, p in URL_RULES]
    ranked = sorted(range(len(URL_RULES)), key=lambda i: -len(URL_RULES[i][1] + URL_RULES[i][2]))
    rule = " ".join(f"WHEN {fits[i]} THEN '{URL_RULES[i][1] + URL_RULES[i][2]}'" for i in ranked)
    verdict = " ".join(f"WHEN {fits[i]} THEN '{URL_RULES[i][0]}'" for i in ranked)
    link = urls.LINK.replace("'", "''")
    rounds = "".join(
        f"""
    r{k + 1} AS MATERIALIZED (SELECT kind, host, sum(rank) AS rank FROM (
      SELECT r.kind, w.t AS host, ((r.rank * {urls.DAMPING}) // 100 // w.total) * w.n AS rank FROM r{k} r JOIN ways w ON r.kind = w.kind AND r.host = w.f
      UNION ALL SELECT kind, host, (rank * {100 - urls.DAMPING}) // 100 FROM r0) GROUP BY ALL),"""
        for k in range(urls.ROUNDS)
    )
    return f"""
    WITH RECURSIVE u AS (SELECT page_id, coalesce(html, '') AS html, coalesce(url, '') AS url FROM pages),
    p AS (SELECT page_id, html, translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 1), '{urls.UPPER}', '{urls.LOWER}') AS host,
      regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 2) AS path FROM u),
    d AS MATERIALIZED (SELECT *, CASE {rule} END AS rule, CASE {verdict} END AS given FROM p),
    found AS MATERIALIZED (SELECT host AS src, translate(unnest(regexp_extract_all(html, '{link}', 1)), '{urls.UPPER}', '{urls.LOWER}') AS dst FROM p WHERE host <> ''),
    family(h) AS (SELECT DISTINCT host FROM p WHERE host <> '' UNION SELECT dst FROM found
      UNION SELECT regexp_extract(h, '(?s)^[^.]*[.](.*)$', 1) FROM family WHERE contains(regexp_extract(h, '(?s)^[^.]*[.](.*)$', 1), '.')),
    pairs AS (SELECT DISTINCT h, regexp_extract(h, '(?s)^[^.]*[.](.*)$', 1) AS p FROM family WHERE contains(regexp_extract(h, '(?s)^[^.]*[.](.*)$', 1), '.')),
    e AS MATERIALIZED (SELECT src, dst, sum(n) AS n FROM (SELECT src, dst, count(*) AS n FROM found WHERE src <> dst GROUP BY ALL
      UNION ALL SELECT h, p, 1 FROM pairs UNION ALL SELECT p, h, 1 FROM pairs) GROUP BY ALL),
    w AS (SELECT 'trust' AS kind, src AS f, dst AS t, n FROM e UNION ALL SELECT 'distrust', dst, src, n FROM e),
    ways AS MATERIALIZED (SELECT *, sum(n) OVER (PARTITION BY kind, f) AS total FROM w),
    s AS (SELECT CASE WHEN given = 'allow' THEN 'trust' ELSE 'distrust' END AS kind, host, count(*) AS n FROM d WHERE given IS NOT NULL GROUP BY ALL),
    r0 AS MATERIALIZED (SELECT kind, host, ({urls.MASS} // sum(n) OVER (PARTITION BY kind)) * n AS rank FROM s),{rounds}
    h AS (SELECT host, sum(CASE WHEN kind = 'trust' THEN rank ELSE 0 END) AS trust, sum(CASE WHEN kind = 'distrust' THEN rank ELSE 0 END) AS distrust
      FROM r{urls.ROUNDS} GROUP BY ALL)
    SELECT page_id, host, path, rule,
      coalesce(given, CASE WHEN distrust * 100 > (trust + distrust) * {urls.THRESHOLD} THEN 'block' ELSE 'allow' END) AS verdict,
      CAST(coalesce(trust, 0) AS BIGINT) AS trust, CAST(coalesce(distrust, 0) AS BIGINT) AS distrust FROM d LEFT JOIN h USING (host)
    """


@query("op3_url_trust", url_sql())
def url_trust(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's url judged by rules, else by its host's trust and distrust."""
    return urls.judge(table(spark, sf_dir, "pages"), URL_RULES, rounds=urls.ROUNDS)


LOWERED = f"translate(coalesce(text, ''), '{urls.UPPER}', '{urls.LOWER}')"


@query("op4_fm_index_decontamination", rf"""
    WITH d AS (SELECT doc_id, regexp_extract_all({LOWERED}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
    b AS (SELECT item_id, regexp_extract_all({LOWERED}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark),
    win AS MATERIALIZED (SELECT DISTINCT item_id, least(len(ws), 10) AS n, array_to_string(ws[i:i + 9], ' ') AS t
      FROM (SELECT item_id, ws, unnest(range(1, greatest(len(ws) - 9, 1) + 1)) AS i FROM b WHERE len(ws) > 0)),
    hit AS MATERIALIZED (SELECT DISTINCT doc_id, item_id, i, c.n FROM (
        SELECT doc_id, n, i, array_to_string(ws[i:i + n - 1], ' ') AS t
        FROM (SELECT doc_id, ws, n, unnest(range(1, len(ws) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM win))) c
      JOIN win ON win.t = c.t AND win.n = c.n),
    words AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hit) GROUP BY 1),
    items AS (SELECT doc_id, count(DISTINCT item_id) AS n_items,
                     string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS ids FROM hit GROUP BY 1)
    SELECT doc_id, len(ws) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
           sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
    FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)
""")
def fm_index_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document hit by windows of benchmark items, and the items."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.occurrences(docs, table(spark, sf_dir, "benchmark"))
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["word_end"] - s["word"])
    ids = F.array_join(F.array_sort(F.transform("items", lambda i: i.cast("string"))), ",")
    return found.select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(ids.cast("binary"), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"),
    )


@query("op5_markov_secrets")
def markov_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document, by pattern and by character models."""
    found = secrets.scan(table(spark, sf_dir, "documents").select("doc_id", "text"))
    base = F.filter("spans", lambda s: s["kind"] < 3)
    count = lambda k: F.size(F.filter("spans", lambda s: s["kind"] == k)).cast("long")
    return found.select(
        "doc_id", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"),
        F.sha2(secrets.written(base).cast("binary"), 256).alias("base_sha256"), secrets.written(F.col("spans")).alias("spans"),
    )


CONTROL_TEXT = "</s>[INST] ok [/INST]"


@query(
    "op6_prefix_target_chat",
    rf"""
    WITH t AS (
      SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
      UNION ALL SELECT -1, 0, 'user', '{CONTROL_TEXT}' UNION ALL SELECT -1, 1, 'assistant', '{CONTROL_TEXT}'),
    m AS (SELECT *, {len(chat.OPEN) + 1 + len(chat.CLOSE)} + length(role) + length(text)
            + len(regexp_extract_all(text, '<[\\]*({chat.ANGLE})')) + len(regexp_extract_all(text, '\[[\\]*({chat.BRACKET})')) AS size FROM t),
    e AS (SELECT *, sum(size) OVER (PARTITION BY conv_id ORDER BY turn) AS prefix FROM m)
    SELECT conv_id, count(*) AS n_turns,
      sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
      CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
      sha256(coalesce(string_agg(text, '' ORDER BY turn) FILTER (role = 'assistant'), '')) AS loss_sha256,
      CAST(sum(size) AS BIGINT) AS formatted_chars, count(*) FILTER (role = 'assistant') AS n_examples,
      CAST(coalesce(sum(prefix) FILTER (role = 'assistant'), 0) AS BIGINT) AS prefix_chars
    FROM e GROUP BY conv_id
    """,
)
def prefix_target_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation formatted and made into examples, and read back: digests of all turns and of the examples' targets."""
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    more = spark.createDataFrame([(-1, 0, "user", CONTROL_TEXT), (-1, 1, "assistant", CONTROL_TEXT)], turns.schema)
    found = chat.digests(chat.formatted(turns.unionByName(more)))
    return found.select("conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "n_examples", "prefix_chars")


def trained_languages(docs: DataFrame) -> language.Model:
    """Fitted on documents whose crc32(doc_id) is not divisible by 5."""
    fold = F.pmod(crc(F.col("doc_id").cast("string")), F.lit(5))
    return language.fit(docs.where(F.coalesce(fold, F.lit(0)) != 0), "doc_id", "text", "lang")


@query("op7_kneser_ney_language_id")
def kneser_ney_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document; learned from four folds of five."""
    docs = table(spark, sf_dir, "documents")
    found = language.identify(docs.select("doc_id", "text"), "text", trained_languages(docs))
    held_out = F.pmod(crc(F.col("doc_id").cast("string")), F.lit(5)) == 0
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "cross_entropy", "rejected")


@query("op8_temperature_mixing", r"""
    WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) + 1 AS k FROM documents),
    n AS (SELECT source, sum(k) AS n FROM d GROUP BY 1),
    a AS (SELECT max(n) AS most, round(greatest(0, 1 - ln(2.0) / ln(max(n) / min(n))), 6) AS e FROM n),
    p AS (SELECT source, n, pow(n / most, e) AS p, most FROM n, a),
    z AS (SELECT sum(p) AS z, round(any_value(most) * sum(p))::BIGINT AS budget FROM p),
    w AS (SELECT source, n::BIGINT AS n, p / z AS weight, greatest(n, ceil(p / z * budget - 1e-6))::BIGINT AS want FROM p, z),
    t AS (SELECT doc_id, source, k, n, weight, want, unnest(range(0, (want + n - 1) // n)) AS epoch FROM d JOIN w USING (source)),
    o AS (SELECT *, epoch * n + coalesce(sum(k) OVER (PARTITION BY source, epoch ORDER BY md5(concat('mix:', doc_id, ':', epoch))
            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS begun FROM t)
    SELECT doc_id, source, epoch::INTEGER AS epoch, (begun * 64 // want)::INTEGER AS block, round(weight, 9) AS weight FROM o WHERE begun < want
""")
def temperature_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sources mixed as flat as two readings of the smallest source allow: every row taken, its epoch and its block."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    mixed, _ = mixing.mix(docs, F.col("source"), repeats=2.0, blocks=64)
    return mixed.select("doc_id", "source", "epoch", "block", F.round("weight", 9).alias("weight"))


@query("op9_tag_ratio_text")
def tag_ratio_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    return htmltext.extract(table(spark, sf_dir, "pages").select("page_id", "url", "html"), "html")


@query("op10_bayes_minhash", rf"""
    WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all({LOWERED}, '[^\x20\x09-\x0D]+') AS ws FROM documents),
    s AS MATERIALIZED (SELECT doc_id, hash(x) AS x FROM (SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) > 1
        THEN [ws[i] || ' ' || ws[i + 1] FOR i IN range(1, len(ws))] ELSE ws END) AS x FROM w)),
    n AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
    p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM s a JOIN s b ON a.x = b.x AND a.doc_id < b.doc_id GROUP BY 1, 2),
    l AS MATERIALIZED (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * k >= 80 * (x.n + y.n - k)),
    e AS MATERIALIZED (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
    r(a, b) AS (SELECT a, b FROM e UNION SELECT r.a, e.b FROM r JOIN e ON e.a = r.b)
    SELECT w.doc_id, coalesce(n.n, 0) AS n_shingles, least(w.doc_id, m.c) AS component_id, w.doc_id = least(w.doc_id, m.c) AS kept
    FROM w LEFT JOIN n USING (doc_id) LEFT JOIN (SELECT a, min(b) AS c FROM r GROUP BY a) m ON m.a = w.doc_id
""")
def bayes_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's component of near copies on two-word shingles."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return neardup.near_duplicates(docs, width=2, percent=80)


@query("op11_characteristic_whitening")
def characteristic_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector along the first 16 components, each of unit variance over the distinct vectors."""
    return whitening.whitened(table(spark, sf_dir, "embeddings"), count=16)


@query("op12_nra_search", rf"""
    WITH t AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({LOWERED}, '{lexical.TERM}') AS ws FROM documents),
    d AS (SELECT r, doc_id, len(ws)::BIGINT AS n FROM t),
    z AS MATERIALIZED (SELECT count(*) FILTER (n > 0) AS docs, sum(n)::BIGINT AS words FROM d),
    i AS MATERIALIZED (SELECT DISTINCT item_id, unnest(regexp_extract_all({LOWERED}, '{lexical.TERM}')) AS term FROM benchmark),
    f AS MATERIALIZED (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(ws) AS term FROM t) SEMI JOIN i USING (term) GROUP BY ALL),
    w AS (SELECT term, CAST(floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM f, z GROUP BY term, docs),
    p AS (SELECT r, term, w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + ((90 * n * docs) // words)))) AS impact FROM f JOIN d USING (r) JOIN w USING (term), z),
    s AS (SELECT item_id, r, CAST(sum(impact) AS BIGINT) AS score FROM i JOIN p USING (term) GROUP BY ALL HAVING sum(impact) > 0),
    o AS (SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank, doc_id, score FROM s JOIN d USING (r) WHERE doc_id IS NOT NULL)
    SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM o WHERE rank <= 10
""")
def nra_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best documents for every benchmark item."""
    return lexical.ranked(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=10)


@query("op13_content_sort", """
    SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size, doc_id = max(doc_id) OVER g AS kept, sha256(t) AS text_sha256
    FROM (SELECT doc_id, coalesce(text, '') AS t FROM documents) WINDOW g AS (PARTITION BY t)
""")
def content_sort(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's group of equal texts; the largest id of each stays."""
    return contentsort.exact_groups(table(spark, sf_dir, "documents").select("doc_id", "text"), "doc_id", "text")
