"""The registered queries of the operators, and DuckDB SQL where SQL can state them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import (
    collocations,
    fm_index,
    katz,
    licenses,
    line_crf,
    merkle,
    minhash_inverted,
    mixing,
    secret_scan,
    subspace_join,
    token_blocks,
    token_counts,
    toxicity_fm,
)
from tessera.llm.common import fold, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return register


# ------------------------------------------------------------------ 9: mixing
#: The mix of the table ``docs`` (doc_id, text, source) as CTEs; the last one is ``mixed``.
MIX_CTES = r"""
 sized AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
   ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT AS place FROM docs),
 per AS (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
 ranked AS (SELECT *, (1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3)::DOUBLE AS weight FROM per),
 levels AS (SELECT *, (sum(source_size) OVER () - 3 * coalesce(sum(source_size) OVER before, 0))
   / (sum(weight) OVER () - coalesce(sum(weight) OVER before, 0)) AS level FROM ranked
   WINDOW before AS (ORDER BY source_size / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
 found AS (SELECT arg_min(level, source_size / weight) AS level FROM levels WHERE level * weight < 3 * source_size),
 targets AS (SELECT source, source_size, least(3.0::DOUBLE * source_size,
   coalesce((SELECT level FROM found), 0) * weight)::DOUBLE AS target FROM ranked),
 copies AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END::BIGINT AS copies FROM targets),
 placed AS (SELECT s.*, source_size, target, copies, target - copies * source_size AS rest,
   sum(size) OVER (PARTITION BY s.source ORDER BY place RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto,
   sum(size) OVER (PARTITION BY s.source, place) AS here
   FROM sized s JOIN copies c ON s.source IS NOT DISTINCT FROM c.source),
 ends AS (SELECT source AS e_source, arg_min(upto - rest < rest - (upto - here), place) AS nearer, min(place) AS cut
   FROM placed WHERE upto > rest GROUP BY source),
 mixed AS (SELECT p.*, copies + CASE WHEN e.cut IS NULL OR place < cut OR (place = cut AND nearer) THEN 1 ELSE 0 END AS n
   FROM placed p LEFT JOIN ends e ON p.source IS NOT DISTINCT FROM e.e_source)"""


@query("op9_mix_sources", f"""
WITH docs AS (SELECT doc_id, text, source FROM documents),{MIX_CTES}
SELECT doc_id, size, source_size, target, (n * size)::BIGINT AS taken FROM mixed""")
def op9_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's share of the mix of weights 1, 2, 3 with at most 3 copies."""
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


# ------------------------------------------------------------------ 6: token counts
def vocabulary(name: str = "word_bpe_49k.json") -> str:
    """Place of a public vocabulary file, the same on every executor."""
    import public_tokenizers
    return public_tokenizers.path(name)


@query("op6_token_counts")
def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact token counts of whole texts, read off their prefix tables."""
    counts = token_counts.prefix_counts(table(spark, sf_dir, "documents"), vocabulary())
    return counts.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > 2048).alias("over_limit"))


# ------------------------------------------------------------------ 8: secrets
@query("op8_secret_scan")
def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document: counts and digest of the pattern kinds, and all spans."""
    found = secret_scan.find_secrets(table(spark, sf_dir, "documents"))

    def of(*kinds):
        return F.filter("spans", lambda s: s["kind"].isin(*kinds))

    return found.select(
        "doc_id", *[F.size(of(k)).cast("long").alias(f"n_{k}") for k in ("assign", "access", "hex")],
        F.sha2(secret_scan.joined(of("assign", "access", "hex")).cast("binary"), 256).alias("base_sha256"),
        secret_scan.joined(F.col("spans")).alias("spans"))


# ------------------------------------------------------------------ 10: token ids
@query("op10_token_blocks")
def op10_token_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of whole texts in patched blocks, written in id order and read back."""
    return token_blocks.write_and_read(table(spark, sf_dir, "documents"), vocabulary())


# ------------------------------------------------------------------ 3: decontamination
_PLAIN = (r"regexp_extract_all(translate(coalesce({}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
          r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')")


@query("op3_fm_decontamination", f"""
WITH docs AS (SELECT doc_id, row_number() OVER () AS doc, {_PLAIN.format("text")} AS ws FROM documents),
 items AS (SELECT coalesce(item_id::VARCHAR, 'null') AS item, {_PLAIN.format("text")} AS ws FROM benchmark),
 windows AS (SELECT DISTINCT item, k, array_to_string(ws[i:i + k - 1], ' ') AS w
   FROM (SELECT item, ws, least(10, len(ws)) AS k, unnest(range(1, len(ws) - least(10, len(ws)) + 2)) AS i FROM items WHERE len(ws) > 0)),
 spots AS (SELECT doc, k, i, array_to_string(ws[i:i + k - 1], ' ') AS w
   FROM (SELECT doc, ws, k, unnest(range(1, len(ws) - k + 2)) AS i FROM docs, (SELECT DISTINCT k FROM windows) WHERE len(ws) >= k)),
 found AS (SELECT doc, s.k, i, item FROM spots s JOIN windows USING (k, w)),
 hits AS (SELECT doc, count(DISTINCT word_no) AS n FROM (SELECT doc, unnest(range(i, i + k)) AS word_no FROM (SELECT DISTINCT doc, i, k FROM found)) GROUP BY doc),
 named AS (SELECT doc, count(DISTINCT item) AS n, string_agg(DISTINCT item, ',' ORDER BY item) AS names FROM found GROUP BY doc)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(h.n, 0) AS n_hit, coalesce(a.n, 0) AS n_items,
 sha256(coalesce(names, '')) AS items_sha256, coalesce(h.n, 0) > 0 AS contaminated
FROM docs LEFT JOIN hits h USING (doc) LEFT JOIN named a USING (doc)""")
def op3_fm_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document inside an occurrence of a ten-word window of a test item."""
    found = fm_index.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    hit = fm_index.hit_words(F.col("spans"))
    return found.select(
        "doc_id", "n_words", hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.sort_array("items"), ",").cast("binary"), 256).alias("items_sha256"),
        (hit > 0).alias("contaminated"))


# ------------------------------------------------------------------ 1 and 7: classifiers
def _judged(scores: DataFrame, least: float) -> DataFrame:
    return scores.select("doc_id", (fold("doc_id", 5) == 0).alias("held_out"), "score",
                         (F.col("score") >= least).cast("int").alias("predicted"))


@query("op1_toxicity_fm")
def op1_toxicity_fm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every whole text; labels outside the fold crc32 mod 5 = 0 teach the model."""
    docs = table(spark, sf_dir, "documents")
    return _judged(toxicity_fm.score(docs, toxicity_fm.train(docs, table(spark, sf_dir, "labels"))), 0.5)


@query("op7_quality_crf")
def op7_quality_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every whole text; labels outside the fold crc32 mod 5 = 0 teach the model."""
    docs = table(spark, sf_dir, "documents")
    return _judged(line_crf.score(docs, line_crf.train(docs, table(spark, sf_dir, "labels"))), line_crf.GOOD)


#: ``component_id`` of every node of ``nodes`` (id) by the pairs in ``pairs`` (x, y, both ways).
_REACH = """ reach(id, other) AS (SELECT id, id FROM nodes UNION SELECT r.id, p.y FROM reach r JOIN pairs p ON p.x = r.other),
 comps AS (SELECT id, min(other) AS component_id FROM reach GROUP BY id)"""


# ------------------------------------------------------------------ 5: near-duplicates
@query("op5_minhash_inverted", r"""
WITH RECURSIVE docs AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
   '[^\x20\x09-\x0D]+') AS ws FROM documents),
 shingles AS (SELECT DISTINCT doc_id, CASE WHEN len(ws) = 1 THEN ws[1] ELSE ws[i] || ' ' || ws[i + 1] END AS s
   FROM (SELECT doc_id, ws, unnest(range(1, greatest(2, len(ws)))) AS i FROM docs WHERE len(ws) > 0)),
 sized AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
 numbered AS (SELECT doc_id, n, hash(s) AS h FROM shingles JOIN sized USING (doc_id)),
 common AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS shared, any_value(a.n) AS n, any_value(b.n) AS m FROM numbered a JOIN numbered b
   ON a.h = b.h AND a.doc_id <> b.doc_id AND 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n) GROUP BY ALL),
 pairs AS (SELECT x, y FROM common WHERE 100 * shared >= 80 * (n + m - shared)),
 nodes AS (SELECT doc_id AS id FROM documents),""" + _REACH + """
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept
FROM documents JOIN comps ON id = doc_id LEFT JOIN sized USING (doc_id)""")
def op5_minhash_inverted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of documents whose two-word shingle sets are at least 80 % alike."""
    return minhash_inverted.near_duplicates(table(spark, sf_dir, "documents"), shingle=2, percent=80)


# ------------------------------------------------------------------ 4: embeddings
@query("op4_subspace_join", f"""
WITH RECURSIVE good AS (SELECT vec_id, label, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings
   WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
   AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
 pairs AS (SELECT a.vec_id AS x, b.vec_id AS y FROM good a JOIN good b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
   WHERE list_dot_product(a.e, b.e) / sqrt(list_dot_product(a.e, a.e) * list_dot_product(b.e, b.e)) >= 0.98),
 nodes AS (SELECT vec_id AS id FROM embeddings),{_REACH},
 degree AS (SELECT x, count(*) AS n FROM pairs GROUP BY x)
SELECT vec_id, coalesce(n, 0) AS n_links, component_id, vec_id = component_id AS kept
FROM embeddings JOIN comps ON id = vec_id LEFT JOIN degree ON x = vec_id""")
def op4_subspace_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vectors of one label whose cosine is at least 0.98, and what they connect."""
    return subspace_join.linked(table(spark, sf_dir, "embeddings"), cosine=0.98)


# ------------------------------------------------------------------ 2: language model
#: Words of an n-gram in the registered query.  Three take more disk than four times the input (README has the figures).
KATZ_ORDER = 2


@query("op2_katz_backoff")
def op2_katz_backoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log10 probability of every whole text; texts outside the fold crc32 mod 7 = 2 teach the model."""
    return katz.score(table(spark, sf_dir, "documents"), fold("doc_id", 7) != 2, order=KATZ_ORDER)


# ------------------------------------------------------------------ 12: Merkle manifest
#: crc32 of a decimal number, a bit at a time: every byte is folded in, then seven bare shifts follow.
_CRC32 = ("xor(list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(string_split(doc_id::VARCHAR, ''), "
          "lambda ch: [ascii(ch)::BIGINT, 0, 0, 0, 0, 0, 0, 0]))), "
          "lambda c, b: xor(xor(c, b) // 2, (xor(c, b) % 2) * 3988292384)), 4294967295::BIGINT)")


def _field(value: str) -> str:
    return f"coalesce(octet_length(encode({value}::VARCHAR))::VARCHAR || ':' || {value}::VARCHAR, '-')"


def _leaf(text: str) -> str:
    return "sha256(" + " || ".join(_field(text if c == "text" else c) for c in merkle.FIELDS) + ")"


def _tree(name: str, nodes: str) -> str:
    """Levels of the trees in ``nodes`` (tree, pos, d, n): ``name`` (tree, lvl, pos, d, n)."""
    return f""" {name} AS (SELECT tree, 0 AS lvl, pos, d, n FROM {nodes} UNION ALL
   SELECT tree, lvl + 1, pos // 8, sha256(string_agg(d, '' ORDER BY pos)), (n + 7) // 8 FROM {name}
   WHERE n > 1 GROUP BY tree, lvl, pos // 8, n),
 {name}_sides AS (SELECT a.tree, a.lvl, a.pos, a.d, a.n,
   coalesce(string_agg(b.d, '' ORDER BY b.pos) FILTER (WHERE b.pos < a.pos), '') AS l,
   coalesce(string_agg(b.d, '' ORDER BY b.pos) FILTER (WHERE b.pos > a.pos), '') AS r
   FROM {name} a JOIN {name} b ON a.tree = b.tree AND a.lvl = b.lvl AND a.pos // 8 = b.pos // 8
   GROUP BY a.tree, a.lvl, a.pos, a.d, a.n)"""


@query("op12_merkle_manifest", f"""
WITH RECURSIVE docs AS (SELECT doc_id, lang, {_leaf("text")} AS leaf,
   CASE WHEN {_CRC32} % 3 = 0 THEN {_leaf(f"translate(text, '{merkle._UPPER}', '{merkle._LOWER}')")} ELSE {_leaf("text")} END AS altered
   FROM documents),
 placed AS (SELECT *, dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS tree,
   row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY lang) AS n FROM docs),
 leaves AS (SELECT tree, pos, leaf AS d, n FROM placed),{_tree("low", "leaves")},
 subroots AS (SELECT 0 AS tree, tree AS pos, d, count(*) OVER () AS n FROM low WHERE n = 1),{_tree("high", "subroots")},
 steps AS (SELECT p.doc_id, p.pos, p.tree, s.lvl, s.l, s.r FROM placed p JOIN low_sides s ON s.tree = p.tree
     AND s.pos = p.pos // (8 ** s.lvl)::BIGINT AND s.n > 1
   UNION ALL SELECT p.doc_id, p.pos, p.tree, 100 + s.lvl, s.l, s.r FROM placed p JOIN high_sides s
     ON s.pos = p.tree // (8 ** s.lvl)::BIGINT AND s.n > 1),
 numbered AS (SELECT *, row_number() OVER (PARTITION BY tree, pos ORDER BY lvl) AS step FROM steps),
 folded AS (SELECT tree, pos, 0 AS step, altered AS d FROM placed UNION ALL
   SELECT f.tree, f.pos, f.step + 1, sha256(s.l || f.d || s.r) FROM folded f
   JOIN numbered s ON s.tree = f.tree AND s.pos = f.pos AND s.step = f.step + 1),
 proofs AS (SELECT tree, pos, sha256(string_agg(l || r, '' ORDER BY step)) AS proof FROM numbered GROUP BY tree, pos),
 ends AS (SELECT tree, pos, arg_max(d, step) AS folded_root FROM folded GROUP BY tree, pos),
 roots AS (SELECT d AS root FROM high WHERE n = 1)
SELECT p.doc_id, p.leaf, s.d AS subroot, root, coalesce(proof, sha256('')) AS proof_sha256, folded_root, folded_root = root AS verified
FROM placed p JOIN ends e USING (tree, pos) JOIN low s ON s.tree = p.tree AND s.n = 1 CROSS JOIN roots
LEFT JOIN proofs q USING (tree, pos)""")
def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's place in the Merkle manifest, and what its proof says of a tampered text."""
    docs = table(spark, sf_dir, "documents")
    found = merkle.Manifest(docs, changed=merkle.tampered(docs)).checked()
    return found.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root",
                        (F.col("folded_root") == F.col("root")).alias("verified"))


# ------------------------------------------------------------------ 13: licences
@query("op13_license_automaton")
def op13_license_automaton(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence phrases and notices in every whole text."""
    found = licenses.find_licenses(table(spark, sf_dir, "documents"))
    base = licenses.base_spans(F.col("spans"))
    starts = F.transform(base, lambda s: s["start"])
    return found.select(
        "doc_id", "n_words", F.size(base).cast("long").alias("n_base"), F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"), licenses.label_list(base).alias("base_labels"),
        licenses.label_list(F.col("spans")).alias("labels"), "score")


# ------------------------------------------------------------------ 11: collocations
_GRAMS = """ grams AS (SELECT lang, size, CASE size WHEN 1 THEN w1 WHEN 2 THEN concat_ws(' ', w1, w2) WHEN 3 THEN concat_ws(' ', w1, w2, w3)
   ELSE concat_ws(' ', w1, w2, w3, w4) END AS p, count(*) AS f FROM spots, (VALUES (1), (2), (3), (4)) sizes(size)
   WHERE size = 1 OR (size = 2 AND w2 IS NOT NULL) OR (size = 3 AND w3 IS NOT NULL) OR (size = 4 AND w4 IS NOT NULL)
   GROUP BY ALL HAVING count(*) >= 30)"""


@query("op11_phrase_collocations", r"""
WITH pieces AS (SELECT coalesce(lang, 'und') AS lang, row_number() OVER () AS doc, unnest(string_split_regex(
   translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
 numbered AS (SELECT lang, row_number() OVER () AS piece_no, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM pieces),
 spots AS (SELECT lang, ws[i] AS w1, ws[i + 1] AS w2, ws[i + 2] AS w3, ws[i + 3] AS w4
   FROM (SELECT lang, ws, unnest(range(1, len(ws) + 1)) AS i FROM numbered)),
 totals AS (SELECT lang, count(*) AS n FROM spots GROUP BY lang),""" + _GRAMS + r""",
 cand AS (SELECT lang, p, f AS a, string_split(p, ' ') AS ws, size FROM grams WHERE size > 1),
 cuts AS (SELECT c.*, k FROM cand c, (VALUES (1), (2), (3)) ks(k) WHERE k < size),
 scored AS (SELECT c.lang, c.p, c.a, c.k, x.f AS l, y.f AS r, ((2000000::HUGEINT * c.a) // (x.f + y.f))::BIGINT AS score FROM cuts c
   JOIN grams x ON x.lang = c.lang AND x.p = array_to_string(c.ws[1:c.k], ' ')
   JOIN grams y ON y.lang = c.lang AND y.p = array_to_string(c.ws[c.k + 1:], ' ')),
 best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, p ORDER BY score, k) = 1),
 subs AS (SELECT lang, a, array_to_string(ws[b:b + m - 1], ' ') AS p FROM cand, (VALUES (2, 1), (2, 2), (2, 3), (3, 1), (3, 2)) sub(m, b)
   WHERE m < size AND b + m - 1 <= size),
 gone AS (SELECT lang, p, max(a) AS a FROM subs GROUP BY lang, p),
 kept AS (SELECT b.* FROM best b LEFT JOIN gone g ON b.lang = g.lang AND b.p = g.p WHERE g.a IS NULL OR 100 * g.a < 80 * b.a)
SELECT lang, rank, p AS phrase, a, l, r, n, score FROM (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, p) AS rank FROM kept) JOIN totals USING (lang)
WHERE rank <= 2000""")
def op11_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each language's 2,000 best collocations."""
    return collocations.collocations(table(spark, sf_dir, "documents"))
