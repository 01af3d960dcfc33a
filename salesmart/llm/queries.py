"""One query per operator, over whole tables with production parameters, and reference SQL where it can be stated."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesmart.llm import (
    byte_bpe,
    context_tree,
    cotraining,
    decontamination,
    kd_search,
    line_dedup,
    merkle_manifest,
    minhash_dedup,
    mixing,
    periodic_runs,
    suffix_dedup,
    token_edits,
    toxicity,
)
from salesmart.llm._shared import FOLD5, FOLD7, fold


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_kd_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = kd_search.top_k(_table(spark, sf_dir, "embeddings"))
    return found.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = line_dedup.dedup_lines(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    kept = F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256)
    return done.select("doc_id", "n_lines", "n_dropped", kept.alias("kept_sha256"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = toxicity.score(docs, toxicity.train(docs, _table(spark, sf_dir, "labels")))
    held_out = F.coalesce(fold(F.col("doc_id"), FOLD5) == 0, F.lit(False))
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op4_context_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = F.coalesce(fold(F.col("doc_id"), FOLD7) == 2, F.lit(False))
    scored = context_tree.score_texts(docs, docs.where(~held_out))
    return scored.select("doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op5_token_edits(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = token_edits.with_cleaning_edits(_table(spark, sf_dir, "documents"))
    return token_edits.recount(docs).drop("text_key")


def op6_cotraining(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source", "n_chars")
    scored = cotraining.score(docs, cotraining.train(docs, _table(spark, sf_dir, "labels")))
    held_out = F.coalesce(fold(F.col("doc_id"), FOLD5) == 0, F.lit(False))
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix_documents(_table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source"))
    return mixed.select("doc_id", F.col("l0").alias("domain"), "lang", "source", "n_tokens", "epoch")


def op8_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = minhash_dedup.near_duplicates(_table(spark, sf_dir, "documents"), size=4, percent=80)
    return done.select("doc_id", "n_shingles", "component_id", "kept")


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"), size=10)
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = suffix_dedup.dedup_substrings(_table(spark, sf_dir, "documents"))
    return done.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op11_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokens = byte_bpe.decode(byte_bpe.encode(_table(spark, sf_dir, "documents").select("doc_id", "text")))
    ids = F.array_join(F.col("ids").cast("array<string>"), ",")
    return tokens.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(ids.cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    found = periodic_runs.periodic_runs(docs.select("doc_id", periodic_runs.planted(F.col("doc_id"), F.col("text")).alias("text")))
    greatest = F.array_min(F.transform("runs", lambda r: F.struct((-r["length"]).alias("l"), r["start"].alias("s"), r["period"].alias("p"))))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    digest = F.concat(F.array_join(lines, "\n"), F.when(F.size("runs") > 0, "\n").otherwise(""))
    rows = found.select("doc_id", "runs", "collapsed", greatest.alias("g"), digest.alias("digest"))
    return rows.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        F.col("g.s").alias("start"),
        (-F.col("g.l")).alias("length"),
        F.col("g.p").alias("period"),
        F.floor(-1000 * F.col("g.l") / F.col("g.p")).cast("long").alias("exponent_milli"),
        F.sha2(F.col("digest").cast("binary"), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "source", "lang", "n_chars", "text")
    struck = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    leaf, changed = merkle_manifest.leaf_digest(), merkle_manifest.leaf_digest(text=merkle_manifest.lowered(F.col("text")))
    proofs = merkle_manifest.prove(merkle_manifest.build(docs, F.when(struck, changed).otherwise(leaf)))
    done = merkle_manifest.verify(proofs.withColumn("proof_sha256", F.sha2(F.col("siblings").cast("binary"), 256)))
    return done.select(F.col("row_id").alias("doc_id"), "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


QUERIES = {
    "op1_kd_search": op1_kd_search,
    "op2_line_dedup": op2_line_dedup,
    "op3_toxicity": op3_toxicity,
    "op4_context_tree": op4_context_tree,
    "op5_token_edits": op5_token_edits,
    "op6_cotraining": op6_cotraining,
    "op7_mixing": op7_mixing,
    "op8_minhash_dedup": op8_minhash_dedup,
    "op9_decontamination": op9_decontamination,
    "op10_suffix_dedup": op10_suffix_dedup,
    "op11_byte_bpe": op11_byte_bpe,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_merkle_manifest": op13_merkle_manifest,
}

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_WORDS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_SPACE = "chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

_CRC = (
    "xor(list_reduce(list_prepend(4294967295::BIGINT, [ascii(ch)::BIGINT FOR ch IN string_split(CAST(doc_id AS VARCHAR), '')]), "
    "lambda c, x: list_reduce(list_prepend(xor(c, x), [1, 1, 1, 1, 1, 1, 1, 1]::BIGINT[]), "
    "lambda a, i: xor(a >> 1, 3988292384 * (a & 1)))), 4294967295)"
)


def _merkle_sql(levels: int = 7, top_levels: int = 3) -> str:
    """The manifest level by level: enough levels for 8**7 rows of a language and 8**3 languages."""

    def field(c: str) -> str:
        return f"coalesce(strlen(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR), '-')"

    def digest(text: str) -> str:
        return f"sha256({field('doc_id')} || {field('source')} || {field('lang')} || {field('n_chars')} || {field(text)})"

    def tree(name: str, depth: int) -> list[str]:
        up = [
            f"{name}{k + 1} AS (SELECT tree, i // 8 AS i, (n + 7) // 8 AS n, CASE WHEN n = 1 THEN min(d) ELSE sha256(string_agg(d, '' ORDER BY i)) END AS d "
            f"FROM {name}{k} GROUP BY tree, i // 8, n)"
            for k in range(depth)
        ]
        groups = [f"{name}g{k} AS (SELECT tree, i // 8 AS g, n, list(d ORDER BY i) AS ds FROM {name}{k} GROUP BY ALL)" for k in range(depth)]
        return up + groups

    def climb(step: int, name: str, k: int, key: str, at: str) -> str:
        rest = f"ds[1:{at} // {8**k} % 8], {{}}ds[{at} // {8**k} % 8 + 2:]"
        siblings = f"array_to_string(list_concat({rest.format('')}), '')"
        group = f"array_to_string(list_concat({rest.format('[cur], ')}), '')"
        return (
            f"f{step + 1} AS (SELECT f.* REPLACE (CASE WHEN g.n = 1 THEN proof ELSE proof || {siblings} END AS proof, "
            f"CASE WHEN g.n = 1 THEN cur ELSE sha256({group}) END AS cur) FROM f{step} f JOIN {name}g{k} g ON g.tree = f.{key} AND g.g = f.{at} // {8 ** (k + 1)})"
        )

    parts = [
        f"leaves AS (SELECT doc_id, lang, {field('lang')} AS tree, {digest('text')} AS leaf, "
        f"CASE WHEN {_CRC} % 3 = 0 THEN {digest(f"translate(text, '{_UPPER}', '{_LOWER}')")} ELSE {digest('text')} END AS shown FROM documents)",
        "placed AS (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i, count(*) OVER (PARTITION BY tree) AS n FROM leaves)",
        "n0 AS (SELECT tree, i, n, leaf AS d FROM placed)",
        *tree("n", levels),
        "langs AS (SELECT tree, any_value(lang) AS lang FROM leaves GROUP BY tree)",
        f"t0 AS (SELECT '' AS tree, tree AS lang_tree, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS i, count(*) OVER () AS n, d FROM n{levels} JOIN langs USING (tree))",
        *tree("t", top_levels),
        "f0 AS (SELECT doc_id, leaf, p.tree, p.i AS i, '' AS top, t0.i AS ti, t0.d AS subroot, '' AS proof, shown AS cur FROM placed p JOIN t0 ON t0.lang_tree = p.tree)",
        *[climb(k, "n", k, "tree", "i") for k in range(levels)],
        *[climb(levels + k, "t", k, "top", "ti") for k in range(top_levels)],
    ]
    return (
        "WITH " + ",\n".join(parts) + f" SELECT doc_id, leaf, subroot, r.d AS root, sha256(proof) AS proof_sha256, cur AS folded_root, cur = r.d AS verified "
        f"FROM f{levels + top_levels}, t{top_levels} r"
    )


ORACLE = {
    "op13_merkle_manifest": _merkle_sql(),
    "op1_kd_search": """
        WITH vectors AS (
            SELECT vec_id, [CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS v FROM embeddings
            WHERE vec_id IS NOT NULL AND len(embedding) > 0
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        scored AS (
            SELECT q.vec_id AS query_id, c.vec_id,
                   CAST(list_sum([q.v[i] * c.v[i] FOR i IN range(1, len(q.v) + 1)]) AS BIGINT) AS score
            FROM vectors q JOIN vectors c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v) WHERE q.vec_id % 100 = 0),
        ranked AS (
            SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM scored)
        SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 10""",
    "op2_line_dedup": f"""
        WITH lines AS (
            SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
                   generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
            FROM documents),
        keyed AS (SELECT *, translate(trim(line, {_SPACE}), '{_UPPER}', '{_LOWER}') AS key FROM lines),
        shared AS (
            SELECT key, max(doc_id) AS keeper FROM keyed WHERE length(key) >= 40
            GROUP BY key HAVING count(DISTINCT doc_id) >= 5),
        marked AS (
            SELECT k.doc_id, k.line, k.pos, s.key IS NOT NULL AND k.doc_id <> s.keeper AS dropped
            FROM keyed k LEFT JOIN shared s ON k.key = s.key)
        SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE dropped) AS n_dropped,
               sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT dropped), '')) AS kept_sha256
        FROM marked GROUP BY doc_id""",
    "op8_minhash_dedup": f"""
        WITH RECURSIVE words AS (
            SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\\x20\\x09-\\x0D]+') AS w
            FROM documents),
        sets AS (
            SELECT DISTINCT doc_id, unnest(
                CASE WHEN len(w) = 0 THEN []
                     WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
                     ELSE [array_to_string(w[i:i + 3], ' ') FOR i IN range(1, len(w) - 2)] END) AS s
            FROM words),
        sizes AS (SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id),
        shared AS (
            SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM sets a JOIN sets b ON a.s = b.s AND a.doc_id < b.doc_id
            GROUP BY a.doc_id, b.doc_id),
        links AS (
            SELECT s.a, s.b FROM shared s JOIN sizes x ON x.doc_id = s.a JOIN sizes y ON y.doc_id = s.b
            WHERE 100 * s.n >= 80 * (x.n + y.n - s.n)),
        ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
        reached AS (
            SELECT doc_id, doc_id AS other FROM documents
            UNION SELECT r.doc_id, e.b FROM reached r JOIN ways e ON e.a = r.other)
        SELECT d.doc_id, coalesce(z.n, 0) AS n_shingles, m.component_id, d.doc_id = m.component_id AS kept
        FROM documents d LEFT JOIN sizes z USING (doc_id)
        JOIN (SELECT doc_id, min(other) AS component_id FROM reached GROUP BY doc_id) m USING (doc_id)""",
    "op9_decontamination": f"""
        WITH words AS (
            SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '{_WORDS}') AS w FROM documents),
        items AS (
            SELECT item_id::VARCHAR AS item_id, regexp_extract_all(translate(text, '{_UPPER}', '{_LOWER}'), '{_WORDS}') AS w
            FROM benchmark WHERE text IS NOT NULL),
        windows AS (
            SELECT DISTINCT item_id, least(10, len(w)) AS size,
                   unnest([array_to_string(w[i:i + least(10, len(w)) - 1], ' ') FOR i IN range(1, len(w) - least(10, len(w)) + 2)]) AS s
            FROM items WHERE len(w) > 0),
        places AS (
            SELECT doc_id, size, unnest(range(1, len(w) - size + 2)) AS start,
                   unnest([array_to_string(w[i:i + size - 1], ' ') FOR i IN range(1, len(w) - size + 2)]) AS s
            FROM words, (SELECT DISTINCT size FROM windows) WHERE len(w) >= size),
        found AS (SELECT DISTINCT p.doc_id, p.start, p.size, w.item_id FROM places p JOIN windows w ON w.size = p.size AND w.s = p.s),
        hit AS (SELECT doc_id, count(DISTINCT pos) AS n FROM (SELECT doc_id, unnest(range(start, start + size)) AS pos FROM found) GROUP BY doc_id),
        named AS (
            SELECT doc_id, count(DISTINCT item_id) AS n, string_agg(DISTINCT item_id, ',' ORDER BY item_id) AS ids FROM found GROUP BY doc_id)
        SELECT w.doc_id, len(w.w) AS n_words, coalesce(h.n, 0) AS n_hit, coalesce(i.n, 0) AS n_items,
               sha256(coalesce(i.ids, '')) AS items_sha256, coalesce(h.n, 0) > 0 AS contaminated
        FROM words w LEFT JOIN hit h USING (doc_id) LEFT JOIN named i USING (doc_id)""",
}
