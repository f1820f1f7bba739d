"""The dealt operators as queries over whole tables, with SQL where it can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsloom.llm import (
    decontamination,
    language_id,
    lm_scoring,
    near_dedup,
    packing,
    quality_classifier,
    quality_rules,
    secret_scan,
    sentencepiece_codec,
    source_divergence,
    token_shards,
    toxicity,
    whitening,
)
from newsloom.llm.common import fold_remainder, table

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


@query
def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.digest(secret_scan.scan(table(spark, sf_dir, "documents").select("doc_id", "text")))


@query
def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").withColumn("held_out", fold_remainder(F.col("doc_id"), 3) == 1)
    model = language_id.train(docs.where(~F.col("held_out")).select("doc_id", "text", "lang"))
    found = language_id.identify(docs.select("doc_id", "held_out", "text"), model)
    return found.select("doc_id", "held_out", "lang_pred", "score", "margin", "rejected")


@query
def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents").select("doc_id", "text"))


@query
def op4_token_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return token_shards.write_shards(docs, token_shards.shard_folder(spark), key=2024)


def labelled(docs: DataFrame, spark: SparkSession, sf_dir: str, label: str) -> DataFrame:
    """Documents with the largest of their labels; rows without one go."""
    labels = table(spark, sf_dir, "labels").where(F.col("doc_id").isNotNull() & F.col(label).isNotNull())
    one = labels.groupBy("doc_id").agg(F.max(label).alias("_label"))
    return docs.join(one, "doc_id").withColumn(label, F.col("_label")).drop("_label")


def toxicity_network(spark: SparkSession, docs: DataFrame, sf_dir: str) -> toxicity.Network:
    """Trained on the labelled rows of `docs` outside the held-out fold."""
    learned = docs.where(fold_remainder(F.col("doc_id"), 4) != 2).select("doc_id", "text", "lang")
    return toxicity.train(labelled(learned, spark, sf_dir, "toxic"), texts=learned)


@query
def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").withColumn("held_out", fold_remainder(F.col("doc_id"), 4) == 2)
    net = toxicity_network(spark, docs, sf_dir)
    found = toxicity.flag(docs.select("doc_id", "held_out", "text", "lang"), net)
    return found.select("doc_id", "held_out", "score", (F.col("score") >= 0.3).cast("int").alias("predicted"), "threshold", "flagged")


@query
def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality_rules.judge(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "quality")


@query
def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").withColumn("held_out", fold_remainder(F.col("doc_id"), 4) == 2)
    learned = docs.where(~F.col("held_out")).select("doc_id", "text")
    model = quality_classifier.train(labelled(learned, spark, sf_dir, "quality"), texts=learned)
    found = quality_classifier.score(docs.select("doc_id", "held_out", "text"), model)
    return found.select("doc_id", "held_out", "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


@query
def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.find(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op9_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Target corpus: the turns of `conversations`; background: all documents, which are then scored."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = lm_scoring.train(docs, table(spark, sf_dir, "conversations"))
    return lm_scoring.score(docs, model).select("doc_id", "n_tokens", "target_loss", "background_loss", "cross_entropy_difference")


@query
def op10_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.groups(table(spark, sf_dir, "documents"))


@query
def op13_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepiece_codec.digest(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")


@query
def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_divergence.audit(table(spark, sf_dir, "documents").select("lang", "source", "text"))


@query
def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whitened(table(spark, sf_dir, "embeddings"))


ORACLES["op2_decontamination"] = r"""
WITH d AS (SELECT doc_id, list_filter(string_split_regex(lower(coalesce(text, '')), '[^\p{L}\p{N}]+'), lambda x: x <> '') AS w FROM documents),
b AS (SELECT item_id, list_filter(string_split_regex(lower(coalesce(text, '')), '[^\p{L}\p{N}]+'), lambda x: x <> '') AS w FROM benchmark),
ds AS (
    SELECT doc_id, unnest(CASE WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(list_slice(w, i, i + 4), ' ')) WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s FROM d
    UNION SELECT doc_id, unnest(list_transform(range(1, len(w) - n + 2), lambda i: array_to_string(list_slice(w, i, i + n - 1), ' '))) FROM d, (SELECT DISTINCT len(w) AS n FROM b WHERE len(w) BETWEEN 1 AND 4)),
bs AS (SELECT DISTINCT item_id, unnest(CASE WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(list_slice(w, i, i + 4), ' ')) WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s FROM b),
n AS (SELECT item_id, count(*) AS n_item FROM bs GROUP BY item_id)
SELECT doc_id, item_id, count(*) AS n_shared, n_item, count(*) / n_item::DOUBLE AS containment
FROM ds JOIN bs USING (s) JOIN n USING (item_id) GROUP BY doc_id, item_id, n_item HAVING count(*) >= 0.8 * n_item
"""

ORACLES["op10_near_dedup"] = r"""
WITH RECURSIVE d AS (
    SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
    FROM documents),
s AS (
    SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 4 THEN list_transform(range(1, len(w) - 2), lambda i: array_to_string(list_slice(w, i, i + 3), ' ')) WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s
    FROM d),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
c AS (SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS k FROM s a JOIN s b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL),
e AS (SELECT u, v FROM c JOIN n x ON x.doc_id = u JOIN n y ON y.doc_id = v WHERE 100 * k >= 80 * (x.n + y.n - k)),
r AS (SELECT doc_id AS node, doc_id AS seen FROM d UNION SELECT r.node, e.v FROM r JOIN e ON e.u = r.seen)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, m.c AS component_id, d.doc_id = m.c AS kept
FROM d LEFT JOIN n USING (doc_id) JOIN (SELECT node, min(seen) AS c FROM r GROUP BY node) m ON m.node = d.doc_id
"""


def either_case(word: str) -> str:
    """A pattern for a word in either case of A to Z only."""
    return "".join(f"[{c.lower()}{c.upper()}]" if c.isalpha() else c for c in word)


def secret_sql() -> str:
    """Places of matches: the texts between matches and the matches themselves, laid end to end."""
    words = ["password", "passwd", "secret", "token"]
    names = "|".join([*map(either_case, words), either_case("api") + "_?" + either_case("key")])
    found = []
    for number, rule in enumerate(secret_scan.RULES):
        pattern = rule.pattern.replace("(?i:password|passwd|secret|token|api_?key)", names).replace("'", "''")
        found.append(
            f"""
            SELECT doc_id, {number} AS rule, '{rule.kind}' AS kind, ms[i] AS m,
              list_sum(list_transform(ps[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(ms[1:i - 1], lambda x: length(x))), 0) AS start
            FROM (SELECT doc_id, ms, ps, unnest(range(1, len(ms) + 1)) AS i FROM (
              SELECT doc_id, regexp_extract_all(text, '{pattern}') AS ms, string_split_regex(text, '{pattern}') AS ps FROM t))
            WHERE length(regexp_extract(ms[i], '{pattern}', {rule.group})) >= {rule.least}"""
        )
    base = len(secret_scan.BASE_RULES)
    shown = "kind || ':' || CAST(start AS BIGINT) || ':' || CAST(start + length(m) AS BIGINT)"
    counts = ", ".join(f"count(*) FILTER (kind = '{r.kind}') AS n_{r.kind}" for r in secret_scan.BASE_RULES)
    return f"""
    WITH t AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
    spans AS ({" UNION ALL ".join(found)})
    SELECT t.doc_id, {counts},
      sha256(coalesce(string_agg({shown}, ',' ORDER BY start, rule) FILTER (rule < {base}), '')) AS base_sha256,
      coalesce(string_agg({shown}, ',' ORDER BY start, rule) FILTER (rule IS NOT NULL), '') AS spans
    FROM t LEFT JOIN spans ON spans.doc_id = t.doc_id GROUP BY t.doc_id
    """


ORACLES["op3_secret_scan"] = secret_sql()


ORACLES["op11_source_divergence"] = r"""
WITH d AS (
    SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
      regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w
    FROM documents),
t AS (SELECT r, lang, source, unnest(w) AS term FROM d),
k AS (SELECT lang, term FROM t GROUP BY lang, term HAVING count(DISTINCT r) >= 10),
g AS (SELECT DISTINCT lang, source FROM d),
v AS (SELECT g.lang, count(k.term) AS v FROM (SELECT DISTINCT lang FROM g) g LEFT JOIN k ON k.lang = g.lang GROUP BY g.lang),
n AS (SELECT lang, source, term, count(*) AS n FROM t GROUP BY ALL),
c AS (SELECT g.lang, g.source, k.term, coalesce(n.n, 0) AS n FROM g JOIN k ON k.lang = g.lang LEFT JOIN n ON n.lang = g.lang AND n.source = g.source AND n.term = k.term),
s AS (SELECT lang, source, sum(n) AS total FROM c GROUP BY ALL),
p AS (SELECT c.lang, c.source, c.term, c.n, 1 + (1000000000::HUGEINT * (c.n + 2)) // (s.total + 2 * v.v) AS p FROM c JOIN s ON s.lang = c.lang AND s.source = c.source JOIN v ON v.lang = c.lang),
lt AS (SELECT lang, term, sum(n) AS n FROM c GROUP BY ALL),
ls AS (SELECT lang, sum(n) AS total FROM lt GROUP BY ALL),
q AS (SELECT lt.lang, lt.term, 1 + (1000000000::HUGEINT * (lt.n + 2)) // (ls.total + 2 * v.v) AS q FROM lt JOIN ls ON ls.lang = lt.lang JOIN v ON v.lang = lt.lang),
f AS (SELECT x.lang, x.source, y.source AS item, sum(((x.p - y.p) * (x.p - y.p)) // (x.p + y.p)) AS value FROM p x JOIN p y ON y.lang = x.lang AND y.term = x.term AND y.source <> x.source GROUP BY ALL),
pairs AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(f.value, 0)::BIGINT AS value FROM g a JOIN g b ON b.lang = a.lang AND b.source <> a.source LEFT JOIN f ON f.lang = a.lang AND f.source = a.source AND f.item = b.source),
terms AS (SELECT p.lang, p.source, 'term' AS part, p.term AS item, (((p.p - q.q) * (p.p - q.q)) // (p.p + q.q))::BIGINT AS value FROM p JOIN q ON q.lang = p.lang AND q.term = p.term WHERE p.n > 0 AND p.p > q.q),
ranked AS (SELECT *, (row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item))::INTEGER AS rank FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms))
SELECT * FROM ranked WHERE part = 'pair' OR rank <= 10
"""
