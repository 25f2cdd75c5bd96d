"""One query per operator, over its whole table with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sonotheca.llm import (decontamination, graph_ann, katz, line_dedup, merkle, mixing, packing, pii, quality, secrets,
                           simhash, url_filter, whitening)
from sonotheca.llm.registry import ORACLE, QUERIES, query, table  # noqa: F401
from sonotheca.session import written


def held_out(remainder: int, modulus: int):
    """Whether the crc32 of the id as text leaves ``remainder``; a null id is never held out."""
    left = F.crc32(F.col("doc_id").cast("string").cast("binary")) % modulus
    return F.coalesce(left == remainder, F.lit(False))


@query("""
WITH dw AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[0-9a-z\\x{80}-\\x{10FFFF}]+') AS w FROM documents),
iw AS (
  SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[0-9a-z\\x{80}-\\x{10FFFF}]+') AS w FROM benchmark),
win AS (
  SELECT DISTINCT item_id, least(len(w), 13) AS size, array_to_string(w[p:p + least(len(w), 13) - 1], ' ') AS t
  FROM (SELECT item_id, w, unnest(range(1, len(w) - least(len(w), 13) + 2)) AS p FROM iw WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT size FROM win),
occ AS (
  SELECT doc_id, size, p, array_to_string(w[p:p + size - 1], ' ') AS t
  FROM (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS p FROM dw, sizes)),
hit AS (SELECT doc_id, item_id, p, occ.size AS size FROM occ JOIN win ON occ.t = win.t AND occ.size = win.size),
nh AS (SELECT doc_id, count(DISTINCT q) AS n FROM (SELECT doc_id, unnest(range(p, p + size)) AS q FROM hit) GROUP BY 1),
it AS (SELECT doc_id, count(*) AS n, string_agg(i, ',' ORDER BY i) AS ids
       FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS i FROM hit) GROUP BY 1)
SELECT d.doc_id, CAST(coalesce(len(w), 0) AS BIGINT) AS n_words, coalesce(nh.n, 0) AS n_hit,
       coalesce(it.n, 0) AS n_items, sha256(coalesce(it.ids, '')) AS items_sha256,
       coalesce(nh.n, 0) > 0 AND 20 * coalesce(nh.n, 0) >= len(w) AS contaminated
FROM dw d LEFT JOIN nh ON d.doc_id = nh.doc_id LEFT JOIN it ON d.doc_id = it.doc_id
""")
def op1_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    """How much of every document is benchmark text, and of which items."""
    found = decontamination.contamination(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    n_hit = decontamination.hit_words(F.col("spans"))
    return found.select(
        F.col("id").alias("doc_id"), "n_words", n_hit.alias("n_hit"),
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        decontamination.is_contaminated(n_hit, F.col("n_words")).alias("contaminated"),
    )


@query()
def op5_simhash(spark: SparkSession, folder: str) -> DataFrame:
    """Fingerprint and near-duplicate component of every document."""
    found = simhash.near_duplicates(table(spark, folder, "documents"))
    return found.select(
        F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.col("component").alias("component_id"),
    )


@query()
def op2_quality(spark: SparkSession, folder: str) -> DataFrame:
    """Quality score of every document; ids with crc32 mod 4 = 2 are held out of the fit."""
    docs = table(spark, folder, "documents")
    model = quality.fit(docs, table(spark, folder, "labels"), usable=~held_out(2, 4))
    found = quality.scored(docs, model, keep=["doc_id"])
    return found.select("doc_id", held_out(2, 4).alias("held_out"), "score",
                        (F.col("score") >= quality.CUT).cast("int").alias("predicted"))


@query()
def op10_mixing(spark: SparkSession, folder: str) -> DataFrame:
    """What a mix of all sources takes of every document."""
    return mixing.Mix(table(spark, folder, "documents")).taken().select(
        F.col("id").alias("doc_id"), "size", "source_size", "target", "taken")


@query()
def op7_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Every document without the runs of lines that repeat earlier ones."""
    found = line_dedup.without_repeats(table(spark, folder, "documents").select("doc_id", "text"))
    return found.select("doc_id", F.col("_units").alias("n_lines"), F.col("_deleted").alias("n_deleted"), "text")


def _joined(spans):
    """Spans as kind:start:end, comma-joined in their order."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def _count(spans, kind: str):
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("bigint")


@query()
def op4_secrets(spark: SparkSession, folder: str) -> DataFrame:
    """Secrets of every document, also those under layers of encoding."""
    found = secrets.secrets(table(spark, folder, "documents"))
    return found.select(
        F.col("id").alias("doc_id"), *(_count("base", k).alias(f"n_{k}") for k in ("assign", "access", "hex")),
        F.sha2(_joined("base").cast("binary"), 256).alias("base_sha256"), _joined("spans").alias("spans"), "layers")


@query()
def op8_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    """Whether every page's url is allowed, by rule or else by naive Bayes."""
    found = url_filter.judged(table(spark, folder, "pages"))
    return found.select(F.col("id").alias("page_id"), "host", "path", "rule", "verdict",
                        F.array_join("words", " ").alias("host_words"), "score")


@query()
def op3_graph_ann(spark: SparkSession, folder: str) -> DataFrame:
    """The 20 vectors with the largest inner product found for every 20th vector."""
    vectors = table(spark, folder, "embeddings")
    index = written(graph_ann.build_index(vectors), "index")
    asked = graph_ann.candidates(vectors, "vec_id", "embedding").where("id % 20 = 0")
    return graph_ann.search(index, asked, 20).select(
        "query_id", "rank", F.col("id").alias("vec_id"), "score")


@query()
def op6_katz(spark: SparkSession, folder: str) -> DataFrame:
    """Log10 probability of every document; ids with crc32 mod 7 = 2 are held out of the counts."""
    found = katz.scored(table(spark, folder, "documents"), ~held_out(2, 7))
    return found.select(F.col("id").alias("doc_id"), (~F.col("train")).alias("held_out"), "n_tokens", "n_known",
                        "train_tokens", "base_score", "score")


@query()
def op9_pii(spark: SparkSession, folder: str) -> DataFrame:
    """Personal data of every document: fixed patterns, and what the model adds."""
    kinds = F.array(*map(F.lit, pii.KINDS))
    named = lambda spans: F.transform(spans, lambda s: F.struct(
        F.get(kinds, s["kind"]).alias("kind"), s["start"].alias("start"), s["end"].alias("end")))
    found = pii.personal_data(table(spark, folder, "documents")).select(
        "id", named("base").alias("base"), named("spans").alias("spans"))
    return found.select(
        F.col("id").alias("doc_id"), *(_count("base", k).alias(f"n_{k}") for k in pii.KINDS),
        F.sha2(_joined("base").cast("binary"), 256).alias("base_sha256"), _joined("spans").alias("spans"))


@query()
def op11_whitening(spark: SparkSession, folder: str) -> DataFrame:
    """Every vector whitened on the four largest components."""
    vectors = table(spark, folder, "embeddings")
    model = whitening.fit(vectors, components=4)
    explained = F.array(*map(F.lit, model.explained)).cast("array<double>")
    return model.transform(vectors).select(
        F.col("id").alias("vec_id"), "deviation", F.posexplode("whitened").alias("place", "whitened"),
    ).select(
        "vec_id", (F.col("place") + 1).alias("component"), F.lit(model.centre.n).cast("bigint").alias("n"), "deviation",
        "whitened", F.get(explained, F.col("place")).alias("explained"),
        F.lit(model.identity_error).cast("double").alias("identity_error"))


@query()
def op12_packing(spark: SparkSession, folder: str) -> DataFrame:
    """Where every piece of every document lies in sequences of 1,024 tokens."""
    return packing.packed(table(spark, folder, "documents")).select(
        F.col("id").alias("doc_id"), "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens",
        "sequence_id", "offset")


_MERKLE_SQL = """
WITH RECURSIVE crcs AS (
  SELECT DISTINCT doc_id, xor(list_reduce(list_concat([4294967295::BIGINT],
           list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: ascii(c)::BIGINT)),
           lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0],
             lambda x, y: xor(x >> 1, 3988292384 * (x & 1)))), 4294967295) AS crc FROM documents),
lined AS (
  SELECT doc_id, lang, concat(coalesce(strlen(CAST(doc_id AS VARCHAR)) || ':' || doc_id, '-'),
                              coalesce(strlen(source) || ':' || source, '-'), coalesce(strlen(lang) || ':' || lang, '-')) AS head,
         n_chars, coalesce(strlen(text) || ':' || text, '-') AS tail FROM documents),
leaves AS (
  SELECT doc_id, lang, sha256(concat(head, coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':' || n_chars, '-'), tail)) AS leaf,
         sha256(concat(head, coalesce(strlen(CAST(n_chars + 1 AS VARCHAR)) || ':' || (n_chars + 1), '-'), tail)) AS changed FROM lined),
placed AS (
  SELECT *, row_number() OVER w - 1 AS ix, count(*) OVER (PARTITION BY lang) AS n
  FROM leaves WINDOW w AS (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf)),
nodes AS (
  SELECT 0 AS level, lang, ix, n, leaf AS h FROM placed
  UNION ALL
  SELECT level + 1, lang, ix // 2, any_value((n + 1) // 2), sha256(string_agg(h, '' ORDER BY ix))
  FROM nodes WHERE n > 1 GROUP BY level, lang, ix // 2),
subroots AS (
  SELECT lang, h AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS lx, count(*) OVER () AS ln
  FROM nodes WHERE n = 1),
tops AS (
  SELECT 0 AS level, lx AS ix, ln AS n, subroot AS h FROM subroots
  UNION ALL
  SELECT level + 1, ix // 2, any_value((n + 1) // 2), sha256(string_agg(h, '' ORDER BY ix))
  FROM tops WHERE n > 1 GROUP BY level, ix // 2),
steps AS (
  SELECT p.doc_id, p.leaf, m.level AS level, m.ix % 2 AS side, s.h AS sibling
  FROM placed p JOIN nodes m ON m.lang IS NOT DISTINCT FROM p.lang AND m.ix = p.ix >> m.level AND m.n > 1
  LEFT JOIN nodes s ON s.lang IS NOT DISTINCT FROM m.lang AND s.level = m.level AND s.ix = xor(m.ix, 1)
  UNION ALL
  SELECT p.doc_id, p.leaf, 1000 + m.level, m.ix % 2, s.h
  FROM placed p JOIN subroots r ON r.lang IS NOT DISTINCT FROM p.lang JOIN tops m ON m.ix = r.lx >> m.level AND m.n > 1
  LEFT JOIN tops s ON s.level = m.level AND s.ix = xor(m.ix, 1)),
paths AS (
  SELECT doc_id, leaf, string_agg(sibling, '' ORDER BY level) AS siblings,
         list({'side': side, 'h': coalesce(sibling, '')} ORDER BY level) AS path FROM steps GROUP BY doc_id, leaf),
folds AS (
  SELECT p.doc_id, p.leaf, p.lang, s.siblings, s.path, 1 AS step,
         CASE WHEN c.crc % 7 = 0 THEN changed ELSE p.leaf END AS h
  FROM placed p LEFT JOIN paths s ON s.doc_id = p.doc_id AND s.leaf = p.leaf
  LEFT JOIN crcs c ON c.doc_id = p.doc_id
  UNION ALL
  SELECT doc_id, leaf, lang, siblings, path, step + 1,
         sha256(CASE path[step].side WHEN 1 THEN path[step].h || h ELSE h || path[step].h END)
  FROM folds WHERE step <= len(path))
SELECT f.doc_id, f.leaf, r.subroot, t.h AS root, sha256(coalesce(f.siblings, '')) AS proof_sha256,
       f.h AS folded_root, f.h = t.h AS verified
FROM folds f JOIN subroots r ON r.lang IS NOT DISTINCT FROM f.lang CROSS JOIN (SELECT h FROM tops WHERE n = 1) t
WHERE f.step = coalesce(len(f.path), 0) + 1
"""


@query(_MERKLE_SQL)
def op13_merkle(spark: SparkSession, folder: str) -> DataFrame:
    """A proof for every document, and whether the row checked against it is the one that was hashed."""
    docs = table(spark, folder, "documents")

    def leaf(n_chars):
        return merkle.hashed(*map(merkle.field, (F.col("doc_id"), F.col("source"), F.col("lang"), n_chars, F.col("text"))))

    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    rows = docs.select(
        "doc_id", F.col("lang").alias("grp"), F.col("doc_id").alias("id"), leaf(F.col("n_chars")).alias("leaf"),
        F.when(tampered, leaf(F.col("n_chars") + 1)).alias("changed"))
    found = merkle.manifest(rows, ["doc_id", "changed"])
    folded = merkle.folded(F.coalesce("changed", "leaf"), F.col("steps"))
    return found.select(
        "doc_id", "leaf", "subroot", "root", merkle.proof_hash(F.col("steps")).alias("proof_sha256"),
        folded.alias("folded_root"), (folded == F.col("root")).alias("verified"))
