"""The registered queries of this subpackage and their SQL equivalents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from perplexis.llm import (
    collocations, debruijn, jaccard, langid, lm, mixing, packing, periodic, quality, sharding, suffixes, topk, tournament,
)
from perplexis.sources.workspace import stored


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def remainder(key: str, divisor: int):
    """``crc32(key as text) mod divisor``."""
    return F.crc32(F.col(key).cast("string").cast("binary")) % divisor


def op2_quality_forest(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    forests = quality.learn(docs, "doc_id", "text", table(spark, folder, "labels"))
    return quality.judge(docs, "doc_id", "text", forests)


def op3_ball_tree_top_k(spark: SparkSession, folder: str) -> DataFrame:
    rows = stored(topk.quantised(table(spark, folder, "embeddings"), "vec_id", "embedding"), "vectors")
    queries = rows.where((F.col("id") % 50 == 0) & (F.col("id") != topk.NO_ID))
    return topk.top_k(rows, queries, 5)


def op5_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    pieces = packing.pieces(table(spark, folder, "documents"), "doc_id", "text")
    return packing.pack(pieces, "length")


def op6_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    held = remainder("doc_id", 4) == 2
    model = langid.learn(docs.where(~held), "doc_id", "text", "lang")
    out = docs.select("doc_id", F.coalesce(held, F.lit(False)).alias("held_out"), "text")
    return langid.predict(out, ["doc_id", "held_out"], "text", model)


def op7_source_mix(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix(table(spark, folder, "documents"), "doc_id", "text", "source")


def op9_extendible_shards(spark: SparkSession, folder: str) -> DataFrame:
    return sharding.shards(table(spark, folder, "documents"), "doc_id", "text")


def op10_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard.join(table(spark, folder, "documents"), "doc_id", "text")


def op8_de_bruijn_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return debruijn.summary(table(spark, folder, "documents"), "doc_id", "text")


def op4_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return suffixes.summary(table(spark, folder, "documents"), "doc_id", "text")


def op1_recurrent_scores(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return lm.score(docs, "doc_id", "text", F.coalesce(remainder("doc_id", 7) != 2, F.lit(True)))


def op11_collocations(spark: SparkSession, folder: str) -> DataFrame:
    return collocations.collocations(table(spark, folder, "documents"), "text", "lang")


def op12_tournament_packing(spark: SparkSession, folder: str) -> DataFrame:
    return tournament.pack(table(spark, folder, "documents"), "doc_id", "text")


def planted_runs(docs: DataFrame) -> DataFrame:
    """``doc_id, text``: in a tenth of the documents a stretch of words repeats to the end, as the contract says."""
    number = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = docs.select("doc_id", "text", number.alias("h"), F.when(number % 10 == 0, F.filter(
        F.split("text", r"[\x20\x09-\x0D]+"), lambda word: word != ""
    )).alias("words"))
    n, g = F.size("words"), F.expr("h div 10")
    planned = words.select("*", n.alias("n"), g.alias("g")).withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n")).cast("int"))
    planned = planned.withColumn("p", (F.lit(1) + F.expr("(n - a) div (3 + g % 8)")).cast("int"))
    rest = F.col("n") - F.col("a")
    period = F.slice("words", F.col("a") + 1, F.col("p"))
    times = F.ceil(rest / F.col("p")).cast("int")
    repeated = F.slice(F.flatten(F.array_repeat(period, times)), 1, rest)
    planted = F.array_join(F.concat(F.slice("words", 1, F.col("a")), repeated), " ")
    return planned.select("doc_id", F.when(F.col("n") > 0, planted).otherwise(F.col("text")).alias("text"))


def op13_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    found = periodic.runs(planted_runs(docs), "doc_id", "text")
    stronger = lambda best, r: F.when(
        best.isNull() | (r["length"] * best["period"] > best["length"] * r["period"]), r
    ).otherwise(best)
    best = F.aggregate("runs", F.lit(None).cast(found.schema["runs"].dataType.elementType), stronger)
    listed = F.transform("runs", lambda r: F.concat(r["start"], F.lit(","), r["length"], F.lit(","), r["period"], F.lit("\n")))
    return found.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"),
        *(F.col(f"best.{c}").alias(c) for c in periodic.RUN),
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(listed, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


QUERIES = {
    "op11_collocations": op11_collocations,
    "op12_tournament_packing": op12_tournament_packing,
    "op13_periodic_runs": op13_periodic_runs,
    "op1_recurrent_scores": op1_recurrent_scores,
    "op4_suffix_dedup": op4_suffix_dedup,
    "op8_de_bruijn_dedup": op8_de_bruijn_dedup,
    "op10_jaccard_join": op10_jaccard_join,
    "op2_quality_forest": op2_quality_forest,
    "op3_ball_tree_top_k": op3_ball_tree_top_k,
    "op5_best_fit_packing": op5_best_fit_packing,
    "op6_language_id": op6_language_id,
    "op7_source_mix": op7_source_mix,
    "op9_extendible_shards": op9_extendible_shards,
}


# Words, and A-Z in lower case, as both engines read them.
_WORDS = r"regexp_extract_all(coalesce({}, ''), '[^\x20\x09-\x0D]+')"
_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_ADDRESS = "('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT"

ORACLE: dict[str, str] = {
    "op3_ball_tree_top_k": """
        WITH v AS (
            SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q FROM embeddings
            WHERE embedding IS NOT NULL
                AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), s AS (
            SELECT a.vec_id AS query_id, b.vec_id, list_dot_product(a.q, b.q)::BIGINT AS score
            FROM v a JOIN v b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id
        ), r AS (
            SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s
        )
        SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM r WHERE rank <= 5
    """,
    "op7_source_mix": f"""
        WITH d AS (
            SELECT doc_id, source, len({_WORDS.format("text")})::BIGINT AS size, {_ADDRESS} AS pos FROM documents
        ), s AS (
            SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS place
            FROM d GROUP BY source
        ), w AS (
            SELECT *, (place - 1) % {len(mixing.WEIGHTS)} + 1 AS weight, source_size / ((place - 1) % {len(mixing.WEIGHTS)} + 1) AS ratio FROM s
        ), l AS (
            SELECT *, (sum(source_size) OVER () - coalesce(sum({mixing.MOST} * source_size) OVER before, 0))::BIGINT
                / (sum(weight) OVER rest)::BIGINT AS share, row_number() OVER (ORDER BY ratio, place) AS nth
            FROM w WINDOW before AS (ORDER BY ratio, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
                rest AS (ORDER BY ratio, place ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)
        ), g AS (
            SELECT *, {mixing.MOST} * source_size <= share * weight AS capped FROM l
        ), t AS (
            SELECT source, source_size, place, CASE WHEN capped THEN ({mixing.MOST} * source_size)::DOUBLE
                ELSE weight * coalesce((SELECT arg_min(share, nth) FROM g WHERE NOT capped), 0) END AS target FROM g
        ), b AS (
            SELECT *, CAST(round(target) AS BIGINT) AS words,
                greatest(1, CAST(ceil(source_size / {mixing.BLOCKS}) AS BIGINT)) AS block FROM t
        ), n AS (
            SELECT *, CAST(ceil(source_size / block) AS BIGINT) AS n_blocks,
                CASE WHEN source_size > 0 THEN words // source_size ELSE 0 END AS passes,
                CASE WHEN source_size > 0 THEN words % source_size ELSE 0 END AS rest FROM b
        ), k AS (
            SELECT *, CAST(passes * n_blocks + ceil(rest / block) AS BIGINT) AS slots FROM n
        ), e AS (
            SELECT *, (sum(slots) OVER (ORDER BY place ROWS UNBOUNDED PRECEDING) - slots)::DOUBLE / sum(slots) OVER () AS low,
                (sum(slots) OVER (ORDER BY place ROWS UNBOUNDED PRECEDING))::DOUBLE / sum(slots) OVER () AS high
            FROM k WHERE slots > 0
        ), points AS (
            SELECT i, i * {mixing.GOLDEN}::DOUBLE - floor(i * {mixing.GOLDEN}::DOUBLE) AS point
            FROM range((SELECT CAST(2 * coalesce(sum(slots), 0) AS BIGINT) FROM k)) x(i)
        ), ranked AS (
            SELECT e.source, e.n_blocks, e.slots, i, row_number() OVER (PARTITION BY e.source ORDER BY i) - 1 AS rank
            FROM points JOIN e ON point >= low AND point < high
        ), first AS (
            SELECT source, rank AS block, i AS first_slot FROM ranked WHERE rank < slots AND rank < n_blocks
        ), places AS (
            SELECT d.*, source_size, target, block, passes, rest, (sum(size) OVER (
                PARTITION BY d.source ORDER BY pos, doc_id, size ROWS UNBOUNDED PRECEDING) - size)::BIGINT AS first
            FROM d JOIN k ON d.source IS NOT DISTINCT FROM k.source
        ), taken AS (
            SELECT *, (passes * size + least(greatest(rest - first, 0), size))::BIGINT AS taken FROM places
        )
        SELECT doc_id, size, taken.source, source_size, target, taken, coalesce(first_slot, -1) AS first_slot
        FROM taken LEFT JOIN first ON taken.source IS NOT DISTINCT FROM first.source AND taken > 0 AND taken.first // taken.block = first.block
    """,
    "op8_de_bruijn_dedup": f"""
        WITH d AS (
            SELECT doc_id, {_WORDS.format("text")} AS words FROM documents
        ), w AS (
            SELECT doc_id, pos, array_to_string(words[pos:pos + {debruijn.K - 1}], ' ') AS key
            FROM (SELECT doc_id, words, unnest(range(1, len(words) - {debruijn.K - 2})) AS pos FROM d)
        ), f AS (
            SELECT doc_id, pos, min(doc_id) OVER (PARTITION BY key) AS first FROM w
        ), gone AS (
            SELECT DISTINCT doc_id, unnest(range(pos, pos + {debruijn.K})) AS pos FROM f WHERE first < doc_id
        ), kept AS (
            SELECT a.doc_id, string_agg(word, ' ' ORDER BY a.pos) AS text
            FROM (SELECT doc_id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS pos FROM d) a
            ANTI JOIN gone ON a.doc_id = gone.doc_id AND a.pos = gone.pos GROUP BY a.doc_id
        )
        SELECT d.doc_id, len(words)::BIGINT AS n_words, coalesce(n, 0)::BIGINT AS n_removed,
            sha256(coalesce(kept.text, '')) AS kept_sha256
        FROM d LEFT JOIN kept ON d.doc_id = kept.doc_id
        LEFT JOIN (SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id) g ON d.doc_id = g.doc_id
    """,
    "op9_extendible_shards": f"""
        WITH d AS (
            SELECT doc_id, strlen(coalesce(text, '')) AS n_bytes, {_ADDRESS} AS bits, row_number() OVER () AS row FROM documents
        ), t AS (
            SELECT d.*, depth, bits >> ({sharding.ADDRESS_BITS} - depth)::BIGINT AS bucket FROM d, range({sharding.ADDRESS_BITS + 1}) x(depth)
        ), s AS (
            SELECT *, sum(n_bytes) OVER b AS shard_bytes, count(*) OVER b AS shard_rows FROM t WINDOW b AS (PARTITION BY depth, bucket)
        ), f AS (
            SELECT *, row_number() OVER (PARTITION BY row ORDER BY depth) AS nth FROM s
            WHERE shard_bytes <= {sharding.LIMIT_BYTES} OR depth = {sharding.ADDRESS_BITS}
        )
        SELECT doc_id, n_bytes, depth, CASE WHEN depth = 0 THEN '' ELSE lpad(bin(bucket), depth::INTEGER, '0') END AS shard,
            shard_bytes::BIGINT AS shard_bytes, shard_rows, shard_bytes > {sharding.LIMIT_BYTES} AS oversized
        FROM f WHERE nth = 1
    """,
    "op11_collocations": f"""
        WITH p AS (
            SELECT coalesce(lang, 'und') AS lang,
                unnest(string_split_regex({_LOWER.format("coalesce(text, '')")}, '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents
        ), w AS (
            SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS words FROM p
        ), e AS (
            SELECT lang, words[i] AS x, words[i + 1] AS y, words[i + 2] AS z
            FROM (SELECT lang, words, unnest(range(1, len(words) + 1)) AS i FROM w)
        ), f1 AS (
            SELECT lang, x, count(*) AS n FROM e GROUP BY ALL
        ), f2 AS (
            SELECT lang, x, y, count(*) AS n FROM e WHERE y IS NOT NULL GROUP BY ALL
        ), f3 AS (
            SELECT lang, x, y, z, count(*) AS n FROM e WHERE z IS NOT NULL GROUP BY ALL HAVING count(*) >= {collocations.LEAST}
        ), held AS (
            SELECT lang, x, y, max(n) AS longer
            FROM (SELECT lang, x, y, n FROM f3 UNION ALL SELECT lang, y, z, n FROM f3) GROUP BY ALL
        ), cuts AS (
            SELECT f2.lang, f2.x || ' ' || f2.y AS phrase, f2.n AS a, 1 AS k, l.n AS l, r.n AS r
            FROM f2 JOIN f1 l ON l.lang = f2.lang AND l.x = f2.x JOIN f1 r ON r.lang = f2.lang AND r.x = f2.y
            LEFT JOIN held ON held.lang = f2.lang AND held.x = f2.x AND held.y = f2.y
            WHERE f2.n >= {collocations.LEAST} AND (longer IS NULL OR 100 * longer < {collocations.INSIDE} * f2.n)
            UNION ALL
            SELECT f3.lang, f3.x || ' ' || f3.y || ' ' || f3.z, f3.n, 1, l.n, r.n
            FROM f3 JOIN f1 l ON l.lang = f3.lang AND l.x = f3.x JOIN f2 r ON r.lang = f3.lang AND r.x = f3.y AND r.y = f3.z
            UNION ALL
            SELECT f3.lang, f3.x || ' ' || f3.y || ' ' || f3.z, f3.n, 2, l.n, r.n
            FROM f3 JOIN f2 l ON l.lang = f3.lang AND l.x = f3.x AND l.y = f3.y JOIN f1 r ON r.lang = f3.lang AND r.x = f3.z
        ), s AS (
            SELECT *, ({collocations.SCALE}::HUGEINT * a * a) // (l::HUGEINT * r) AS score FROM cuts
        ), best AS (
            SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
        ), ranked AS (
            SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM best
        )
        SELECT lang, rank, phrase, a, l, r, total.n::BIGINT AS n, score::BIGINT AS score
        FROM ranked JOIN (SELECT lang, sum(n) AS n FROM f1 GROUP BY lang) total USING (lang)
        WHERE rank <= {collocations.TOP}
    """,
    "op10_jaccard_join": f"""
        WITH RECURSIVE d AS (
            SELECT doc_id, {_WORDS.format(_LOWER.format("text"))} AS words FROM documents
        ), s AS (
            SELECT DISTINCT doc_id, array_to_string(words[pos:pos + {jaccard.SHINGLE - 1}], ' ') AS shingle
            FROM (SELECT doc_id, words, unnest(range(1, greatest(len(words) - {jaccard.SHINGLE - 1}, 1) + 1)) AS pos FROM d WHERE len(words) > 0)
        ), n AS (
            SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
        ), p AS (
            SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common
            FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id GROUP BY ALL
        ), links AS (
            SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b
            WHERE 100 * common >= {jaccard.PERCENT} * (x.n + y.n - common)
        ), reach AS (
            SELECT doc_id AS a, doc_id AS b FROM d UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a
        )
        SELECT d.doc_id, coalesce(n, 0) AS n_shingles, min(b) AS component_id
        FROM d LEFT JOIN n ON n.doc_id = d.doc_id JOIN reach ON a = d.doc_id GROUP BY d.doc_id, n
    """,
}
