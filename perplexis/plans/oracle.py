"""The registered queries as DuckDB SQL over the same tables.

Each statement is self-contained: it starts from the given tables and uses only
those of the named steps below that it needs.
"""

from __future__ import annotations

from perplexis.functions.decision import (
    DISPLAY_NAMES, HUMAN_LABEL, MACHINE_LABEL, THRESHOLDS,
)
from perplexis.functions.text import DEFAULT_MAX_TOKENS, MINIMUM_TOKENS
from perplexis.operators.evaluation import LOG_GRID, REPORTED_FPR
from perplexis.operators.sampling import COUNT_UNITS, DIGITS
from perplexis.plans.registry import (
    BATCH_SIZE, FILES_PER_SOURCE, LISTED_TOKENS, MASK_TOKENS, PAD, ROWS_PER_FILE, SEED, TEMPERATURE,
)

ALPHA, LAM = "0.5e0", "0.7e0"
K = "src, doc_id, turn"
NAN = "CAST('NaN' AS DOUBLE)"
INF = "CAST('Infinity' AS DOUBLE)"
TOKEN = r"'[\p{L}\p{N}]+'"
NON_BLANK = (
    r"'[^\s\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]'"
)


def lit(value: float) -> str:
    return f"CAST('{value!r}' AS DOUBLE)"


def scoreable(text: str = "text") -> str:
    return f"regexp_matches(coalesce({text}, ''), {NON_BLANK})"


def label(score: str, threshold: str) -> str:
    below = f"NOT isnan({score}) AND {score} < {threshold}"
    return f"CASE WHEN {below} THEN '{MACHINE_LABEL}' ELSE '{HUMAN_LABEL}' END"


def _text_steps() -> dict[str, str]:
    return {
        "texts": """SELECT 'documents' AS src, doc_id, CAST(0 AS BIGINT) AS turn, text FROM documents
            UNION ALL SELECT 'conversations', conv_id, turn, text FROM conversations""",
        "toks": f"SELECT {K}, regexp_extract_all(lower(text), {TOKEN}) AS tokens FROM texts",
        "pos": f"SELECT {K}, unnest(tokens) AS tok, generate_subscripts(tokens, 1) AS pos FROM toks",
        "nx": f"SELECT *, lead(tok) OVER (PARTITION BY {K} ORDER BY pos) AS nxt FROM pos",
    }


def _model_steps(same: bool = False) -> dict[str, str]:
    q = "count(*) FILTER (src = 'documents')" if same else "count(*)"
    return {
        "bi": f"""SELECT tok AS prev, nxt AS tok, count(*) FILTER (src = 'documents') AS n_p, {q} AS n_q
            FROM nx WHERE nxt IS NOT NULL GROUP BY ALL""",
        "uni": f"SELECT tok, count(*) FILTER (src = 'documents') AS n_p, {q} AS n_q FROM pos GROUP BY tok",
        "ctx": """SELECT prev, CAST(sum(n_p) AS BIGINT) AS c_p, CAST(sum(n_q) AS BIGINT) AS c_q
            FROM bi GROUP BY prev""",
        "tot": f"""SELECT sum(n_p) + {ALPHA} * (count(*) + 1) AS d_p, sum(n_q) + {ALPHA} * (count(*) + 1) AS d_q
            FROM uni""",
        "u": f"""SELECT tok, n_p, n_q, (n_p + {ALPHA}) / (SELECT d_p FROM tot) AS u_p,
            (n_q + {ALPHA}) / (SELECT d_q FROM tot) AS u_q FROM uni""",
        "prob": f"""SELECT b.prev, b.tok, u_p, u_q, b.n_p, b.n_q,
            CASE WHEN c_p > 0 THEN {LAM} * b.n_p / c_p + (1e0 - {LAM}) * u_p ELSE u_p END AS pp,
            CASE WHEN c_q > 0 THEN {LAM} * b.n_q / c_q + (1e0 - {LAM}) * u_q ELSE u_q END AS pq
            FROM bi b JOIN u ON u.tok = b.tok JOIN ctx ON ctx.prev = b.prev""",
    }


def _metric_steps(temperature: float = 1.0) -> dict[str, str]:
    r = f"(1e0 / {lit(temperature)})"
    t = lit(temperature)
    return {
        "g": f"""SELECT sum(pow(u_p, {r})) + any_value(pow({ALPHA} / (SELECT d_p FROM tot), {r})) AS s_p,
            sum(pow(u_q, {r})) + any_value(pow({ALPHA} / (SELECT d_q FROM tot), {r})) AS s_q,
            sum(pow(u_p, {r}) * ln(u_q)) + any_value(pow({ALPHA} / (SELECT d_p FROM tot), {r})
            * ln({ALPHA} / (SELECT d_q FROM tot))) AS x FROM u""",
        "es": f"""SELECT prev, sum(pow(pp, {r})) AS e_p, sum(pow(pq, {r})) AS e_q, sum(pow(pp, {r}) * ln(pq)) AS cr,
            sum(pow(u_p, {r})) AS a, sum(pow(u_q, {r})) AS b, sum(pow(u_p, {r}) * ln(u_q)) AS al
            FROM prob GROUP BY prev""",
        "ks": f"""SELECT u.tok, coalesce(e_p, 0) AS e_p, coalesce(e_q, 0) AS e_q, coalesce(cr, 0) AS cr,
            coalesce(a, 0) AS a, coalesce(b, 0) AS b, coalesce(al, 0) AS al,
            (SELECT s_p FROM g) AS s_p, (SELECT s_q FROM g) AS s_q, (SELECT x FROM g) AS x,
            pow(CASE WHEN c_p > 0 THEN 1e0 - {LAM} ELSE 1e0 END, {r}) AS k_p,
            pow(CASE WHEN c_q > 0 THEN 1e0 - {LAM} ELSE 1e0 END, {r}) AS k_q,
            ln(CASE WHEN c_q > 0 THEN 1e0 - {LAM} ELSE 1e0 END) AS lk
            FROM u LEFT JOIN es ON es.prev = u.tok LEFT JOIN ctx ON ctx.prev = u.tok""",
        "zs": "SELECT *, e_p + k_p * (s_p - a) AS z_p, ln(e_q + k_q * (s_q - b)) AS lz FROM ks",
        "xc": f"""SELECT tok, lz, z_p AS mass_p, exp(lz) AS mass_q,
            -(cr / {t} - lz * e_p + k_p * ((lk / {t} - lz) * (s_p - a) + (x - al) / {t})) / z_p AS h FROM zs""",
        "tm": f"""SELECT {K}, pos, nx.tok, h, -(ln(pq) / {t} - lz) AS nll
            FROM nx JOIN xc ON xc.tok = nx.tok LEFT JOIN prob ON prob.prev = nx.tok AND prob.tok = nx.nxt""",
        "ds": f"""SELECT {K}, count(*) AS n_tokens, coalesce(avg(nll), {NAN}) AS ppl, avg(h) AS x_ppl,
            coalesce(avg(nll), {NAN}) / avg(h) AS score FROM tm GROUP BY ALL""",
    }


def _file_steps() -> dict[str, str]:
    return {
        "dirty": """SELECT doc_id, source AS file, lang, text FROM documents
            UNION ALL SELECT -1 - doc_id, source, lang, CASE doc_id % 4 WHEN 1 THEN ''
            WHEN 2 THEN chr(9) || chr(160) WHEN 3 THEN '!!!' END FROM documents""",
        "scored": f"""SELECT dirty.*, CASE WHEN {scoreable('dirty.text')} AND
            len(regexp_extract_all(lower(dirty.text), {TOKEN})) > 0
            THEN coalesce(score, {NAN}) ELSE {NAN} END AS score
            FROM dirty LEFT JOIN ds ON ds.src = 'documents' AND ds.doc_id = dirty.doc_id""",
        "partly": f"""SELECT doc_id, file, lang, text, CASE lang WHEN 'de' THEN NULL WHEN 'es' THEN {NAN}
            ELSE score END AS score FROM scored""",
        "gaps": f"""SELECT doc_id, file, {scoreable()} AS scoreable FROM partly
            WHERE score IS NULL OR isnan(score)""",
    }


def _evaluation_steps() -> dict[str, str]:
    accuracy = lit(THRESHOLDS["accuracy"])
    return {
        "ev": f"""SELECT score, class, CASE WHEN NOT isnan(score) AND score < {accuracy} THEN 1 ELSE 0 END AS pred
            FROM (SELECT round(ds.score, 6) AS score, CASE role WHEN 'assistant' THEN 1 ELSE 0 END AS class
            FROM ds JOIN conversations c ON ds.src = 'conversations' AND ds.doc_id = c.conv_id AND ds.turn = c.turn)""",
        "grp": """SELECT score, count(*) FILTER (class = 1) AS pos, count(*) FILTER (class = 0) AS neg
            FROM ev WHERE NOT isnan(score) GROUP BY score""",
        "cum": """SELECT *, CAST(sum(pos) OVER w AS BIGINT) AS tp, CAST(sum(neg) OVER w AS BIGINT) AS fp,
            CAST(sum(pos) OVER () AS BIGINT) AS p, CAST(sum(neg) OVER () AS BIGINT) AS n FROM grp
            WINDOW w AS (ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""",
        "roc": f"""SELECT -score AS threshold, fp, tp, fp / CAST(n AS DOUBLE) AS fpr, tp / CAST(p AS DOUBLE) AS tpr
            FROM cum UNION ALL SELECT {INF}, CAST(0 AS BIGINT), CAST(0 AS BIGINT), 0e0, 0e0""",
        "cand": f"""SELECT score AS threshold, tp - pos AS tp, fp - neg AS fp, p, n FROM cum
            UNION ALL SELECT {INF}, max(p), max(n), max(p), max(n) FROM cum""",
        "f1s": """SELECT count(*) AS n, count(*) FILTER (isnan(score)) AS n_missing,
            2e0 * count(*) FILTER (class = 1 AND pred = 1) / (2 * count(*) FILTER (class = 1 AND pred = 1)
            + count(*) FILTER (class = 0 AND pred = 1) + count(*) FILTER (class = 1 AND pred = 0)) AS f1 FROM ev""",
        "auc": "SELECT sum(neg * (tp - pos / 2e0)) / (max(p) * max(n)) AS auc FROM cum",
    }


STEPS = {**_text_steps(), **_model_steps(), **_metric_steps(), **_file_steps(), **_evaluation_steps()}


def statement(body: str, last: str | None = None, steps: dict[str, str] | None = None) -> str:
    """``body`` after all steps up to the step named ``last``."""
    if last is None:
        return body
    steps = steps or STEPS
    names = list(steps)[: list(steps).index(last) + 1]
    return "WITH " + ",\n".join(f"{n} AS MATERIALIZED ({steps[n]})" for n in names) + "\n" + body


ROUNDED = f"SELECT {K}, n_tokens, round(ppl, 6) AS ppl, round(x_ppl, 6) AS x_ppl, round(score, 6) AS score"


def _per_text(value: str, name: str, temperature: float = 1.0) -> str:
    steps = {**_text_steps(), **_model_steps(), **_metric_steps(temperature)}
    return statement(
        f"SELECT {K}, round(coalesce({value}, {NAN}), 6) AS {name} FROM tm GROUP BY {K}", "tm", steps
    )


def _tpr_at(rates: list[float], digits: str) -> str:
    """The curve at each rate: last point at or below it, first point above it."""
    grid = ", ".join(f"({lit(x)})" for x in rates)
    return statement(
        f""", grid AS (SELECT * FROM (VALUES {grid}) v(x)),
        l AS (SELECT x, max(fpr) AS lx, arg_max(tpr, (fpr, tpr)) AS ly FROM grid JOIN roc ON fpr <= x GROUP BY x),
        r AS (SELECT x, min(fpr) AS rx, arg_min(tpr, (fpr, tpr)) AS ry FROM grid JOIN roc ON fpr > x GROUP BY x)
        SELECT {digits} AS fpr,
        round(CASE WHEN rx IS NULL THEN ly ELSE ly + (ry - ly) / (rx - lx) * (l.x - lx) END, 6) AS tpr
        FROM l LEFT JOIN r ON r.x = l.x""",
        "roc",
    ).replace(")\n, grid", "),\ngrid")


def _uniform(name: str) -> str:
    first, n = DIGITS[name]
    text = f"concat_ws(':', '{SEED}', src, doc_id, turn, pos)"
    return f"(CAST('0x' || substr(md5({text}), {first}, {n}) AS BIGINT) / {float(16**n)!r}::DOUBLE)"


def _sampled() -> str:
    """Draws from alias tables whose lines of deficits and surpluses meet by as-of joins."""
    return statement(
        f""", w AS (SELECT prev AS c, tok AS drawn, CAST(n_p AS HUGEINT) AS w FROM prob WHERE n_p > 0
            UNION ALL SELECT '', tok, CAST(round((n_p + {ALPHA}) * {COUNT_UNITS}) AS HUGEINT) FROM u
            UNION ALL SELECT '', '', CAST(round({ALPHA} * {COUNT_UNITS}) AS HUGEINT)),
        o AS (SELECT *, sum(w) OVER (PARTITION BY c) AS total, count(*) OVER (PARTITION BY c) AS k FROM w),
        a AS (SELECT c, drawn, total, k, w * k > total AS heavy, abs(w * k - total) AS amount FROM o),
        l AS (SELECT *, sum(amount) OVER line AS upto, row_number() OVER line AS place FROM a
            WINDOW line AS (PARTITION BY c, heavy ORDER BY drawn ROWS UNBOUNDED PRECEDING)),
        light AS (SELECT *, upto - amount AS start FROM l WHERE NOT heavy),
        heavy AS (SELECT *, upto - amount AS start FROM l WHERE heavy),
        stretch AS (SELECT c, start, max(upto) AS upto FROM light GROUP BY ALL),
        cells AS (
            SELECT light.c, light.place - 1 AS cell, light.k, (light.total - light.amount)::DOUBLE / light.total::DOUBLE AS share,
                light.drawn AS own, coalesce(heavy.drawn, light.drawn) AS other
            FROM light ASOF LEFT JOIN heavy ON light.c = heavy.c AND light.start >= heavy.start
            UNION ALL
            SELECT h.c, h.k - h.place, h.k, (h.total - greatest(0, stretch.upto - h.upto))::DOUBLE / h.total::DOUBLE,
                h.drawn, coalesce(following.drawn, h.drawn)
            FROM heavy h ASOF LEFT JOIN stretch ON h.c = stretch.c AND h.upto > stretch.start
            LEFT JOIN heavy following ON following.c = h.c AND following.start = h.upto),
        sizes AS (SELECT c, any_value(k) AS k FROM cells GROUP BY c),
        d AS (SELECT {K}, pos, pos.tok,
            CASE WHEN c_p > 0 AND {_uniform("part")} < {LAM} THEN pos.tok ELSE '' END AS c, {_uniform("place")} AS place, {_uniform("choice")} AS choice
            FROM pos LEFT JOIN ctx ON ctx.prev = pos.tok),
        found AS (SELECT {K}, d.tok, CASE WHEN choice < share THEN own ELSE other END AS drawn
            FROM d JOIN sizes ON sizes.c = d.c JOIN cells ON cells.c = d.c AND cells.cell = CAST(floor(d.place * sizes.k) AS BIGINT)),
        val AS (SELECT {K}, -ln(CASE WHEN c_q > 0 THEN {LAM} * coalesce(bi.n_q, 0) / c_q + (1e0 - {LAM}) * uq
            ELSE uq END) AS nll
            FROM (SELECT found.*, coalesce(u_q, {ALPHA} / d_q) AS uq
                FROM found LEFT JOIN u ON u.tok = found.drawn, tot) f
            LEFT JOIN bi ON bi.prev = f.tok AND bi.tok = f.drawn LEFT JOIN ctx ON ctx.prev = f.tok)
        SELECT {K}, round(avg(nll), 6) AS x_ppl FROM val GROUP BY {K}""",
        "prob",
    ).replace(")\n, w AS", "),\nw AS")


def _logits() -> str:
    """Listed tokens of a context at a temperature, and all others as one tail of equals."""
    t = lit(TEMPERATURE)
    size = "(SELECT count(*) + 1 FROM u) - m"
    each = {r: f"(ln(rest_{r}) - ln({size})) / {t}" for r in "pq"}
    return statement(
        f""", ranked AS (SELECT *, row_number() OVER (PARTITION BY prev ORDER BY n_q DESC, tok) AS place FROM prob),
        listed AS (SELECT * FROM ranked WHERE place <= {LISTED_TOKENS}),
        tails AS (SELECT u.tok AS prev, count(listed.tok) AS m, 1e0 - coalesce(sum(pp), 0e0) AS rest_p,
            1e0 - coalesce(sum(pq), 0e0) AS rest_q, coalesce(sum(exp(ln(pp) / {t})), 0e0) AS e_p,
            coalesce(sum(exp(ln(pq) / {t})), 0e0) AS e_q
            FROM u LEFT JOIN listed ON listed.prev = u.tok GROUP BY u.tok),
        norms AS (SELECT prev, {size} AS size, {each["p"]} AS each_p, {each["q"]} AS each_q,
            ln(e_p + ({size}) * exp({each["p"]})) AS z_p, ln(e_q + ({size}) * exp({each["q"]})) AS z_q FROM tails),
        hs AS (SELECT norms.prev, any_value(size * exp(each_p - z_p) * (z_q - each_q))
            + coalesce(sum(exp(ln(pp) / {t} - z_p) * (z_q - ln(pq) / {t})), 0e0) AS h
            FROM norms LEFT JOIN listed ON listed.prev = norms.prev GROUP BY norms.prev)
        SELECT {K}, CAST(pos AS INTEGER) AS pos, nx.tok,
            round(CASE WHEN nxt IS NOT NULL THEN z_q - coalesce(ln(pq) / {t}, each_q) END, 6) AS nll, round(h, 6) AS h
        FROM nx JOIN norms ON norms.prev = nx.tok JOIN hs ON hs.prev = nx.tok
        LEFT JOIN listed ON listed.prev = nx.tok AND listed.tok = nx.nxt WHERE src = 'conversations'""",
        "prob",
    ).replace(")\n, ranked AS", "),\nranked AS")


def _self_entropy() -> str:
    steps = {**_text_steps(), **_model_steps(same=True), **_metric_steps()}
    # A pair of conversation tokens only has no row with a count, but a probability.
    return statement(f"{ROUNDED} FROM ds", "ds", steps)


def _table_counts(names: list[str]) -> str:
    return " UNION ALL ".join(f"SELECT '{n}.parquet' AS file, count(*) AS n_rows FROM {n}" for n in names)


GIVEN = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
         "embeddings", "pages", "benchmark", "labels", "conversations"]


def oracle_sql() -> dict[str, str]:
    low_fpr, accuracy = lit(THRESHOLDS["low-fpr"]), lit(THRESHOLDS["accuracy"])
    modes = " UNION ALL ".join(
        f"SELECT '{m}' AS mode, '{DISPLAY_NAMES[m]}' AS shown, {lit(x)} AS threshold" for m, x in THRESHOLDS.items()
    )
    masked = ", ".join(f"'{t}'" for t in MASK_TOKENS)
    joined = f"SELECT {K}, CAST(len(tokens) AS INTEGER) AS n_tokens, array_to_string(tokens, ' ') AS tokens"
    first = f"SELECT {K}, tokens[1:{DEFAULT_MAX_TOKENS}] AS tokens FROM toks"
    backfilled = (
        f"SELECT p.doc_id, p.file, round(CASE WHEN (p.score IS NULL OR isnan(p.score)) AND {scoreable('p.text')} "
        "AND len(regexp_extract_all(lower(p.text), " + TOKEN + ")) > 0 THEN s.score ELSE p.score END, 6) AS score "
        "FROM partly p JOIN scored s ON s.doc_id = p.doc_id"
    )
    curve = "threshold, fp, tp, round(fpr, 6) AS fpr, round(tpr, 6) AS tpr"
    long = "SELECT 'observer' AS model, {} FROM {} UNION ALL SELECT 'performer', {} FROM {}"
    external = {**_text_steps(), "tm": f"""SELECT {K}, pos, tok, CASE WHEN nxt IS NOT NULL
        THEN ln(1e0 + length(nxt)) END AS nll, ln(2e0 + length(tok)) AS h FROM nx""",
                "ds": _metric_steps()["ds"]}
    window = {**_text_steps(), **_model_steps(), **_metric_steps(), "cut": f"""SELECT {K}, h,
        CASE WHEN pos < {DEFAULT_MAX_TOKENS} THEN nll END AS nll FROM tm WHERE pos <= {DEFAULT_MAX_TOKENS}""",
              "dw": _metric_steps()["ds"].replace("FROM tm", "FROM cut")}
    return {
        "scan_documents": "SELECT doc_id, text, lang, source, n_chars FROM documents",
        "collect_inputs": _table_counts(GIVEN),
        "exclude_outputs": statement(
            f"""SELECT file || '-' || ((doc_id % {FILES_PER_SOURCE} + {FILES_PER_SOURCE}) % {FILES_PER_SOURCE}) || '.parquet' AS file,
            count(*) AS n_rows FROM dirty GROUP BY ALL""", "dirty"),
        "scan_jsonl": "SELECT doc_id, lang, text FROM documents",
        "write_scored": statement("SELECT doc_id, file, lang, text, round(score, 6) AS score FROM scored", "scored"),
        "backfill_write": statement(backfilled, "partly"),
        "write_eval_csv": statement("SELECT * FROM ev", "ev"),
        "normalize_text": statement("SELECT doc_id, coalesce(text, '') AS text FROM dirty", "dirty"),
        "split_scoreable": statement(f"SELECT doc_id, file, {scoreable()} AS scoreable FROM dirty", "dirty"),
        "token_count": statement(f"SELECT {K}, CAST(len(tokens) AS INTEGER) AS n_tokens FROM toks", "toks"),
        "tokenize": statement(
            f"""{joined}, coalesce(ids, '') AS ids FROM toks LEFT JOIN (
                SELECT {K}, string_agg(id, ' ' ORDER BY pos) AS ids
                FROM pos JOIN (SELECT tok, row_number() OVER (ORDER BY tok) AS id FROM uni) numbered USING (tok) GROUP BY ALL
            ) USING ({K})""", "uni"),
        "truncate_tokens": statement(f"{joined} FROM ({first})", "toks"),
        "token_positions": statement(f"SELECT {K}, CAST(pos AS INTEGER) AS pos, tok FROM pos", "pos"),
        "next_token_pairs": statement(f'SELECT {K}, CAST(pos AS INTEGER) AS pos, tok, nxt AS "next" FROM nx', "nx"),
        "pad_mask": statement(
            f"""SELECT {K}, batch_id, array_to_string(list_concat(tokens, list_value('{PAD}')[1:0]), ' ')
                || repeat(' {PAD}', m - len(tokens)) AS padded,
                repeat('1', len(tokens)) || repeat('0', m - len(tokens)) AS mask
            FROM (SELECT *, max(len(tokens)) OVER (PARTITION BY src, batch_id) AS m FROM (
                SELECT *, (row_number() OVER (PARTITION BY src ORDER BY doc_id, turn) - 1) // {BATCH_SIZE} AS batch_id
                FROM toks))""", "toks"),
        "vocab_diff": statement(
            """SELECT tok, coalesce(l.id, 0) AS left_id, coalesce(r.id, 0) AS right_id
            FROM (SELECT tok, row_number() OVER (ORDER BY tok) AS id FROM uni WHERE n_p > 0) l
            FULL JOIN (SELECT tok, row_number() OVER (ORDER BY tok) AS id FROM uni WHERE n_q > n_p) r USING (tok)
            WHERE l.id IS DISTINCT FROM r.id""", "uni"),
        "lm_unigram": statement(long.format("tok, n_p AS n, round(u_p, 12) AS u", "u",
                                            "tok, n_q, round(u_q, 12)", "u"), "u"),
        "lm_bigram": statement(long.format("prev, tok, n_p AS n", "bi WHERE n_p > 0", "prev, tok, n_q", "bi"), "bi"),
        "lm_context": statement(long.format("prev, c_p AS n", "ctx WHERE c_p > 0", "prev, c_q", "ctx"), "ctx"),
        "softmax_check": statement("SELECT tok, round(mass_p, 6) AS mass_p, round(mass_q, 6) AS mass_q FROM xc", "xc"),
        "xent_by_context": statement("SELECT tok AS prev, round(h, 6) AS h FROM xc", "xc"),
        "token_nll": statement(f"SELECT {K}, CAST(pos AS INTEGER) AS pos, tok, round(nll, 6) AS nll FROM tm "
                               "WHERE nll IS NOT NULL", "tm"),
        "token_xent": statement(f"SELECT {K}, CAST(pos AS INTEGER) AS pos, tok, round(h, 6) AS h FROM tm", "tm"),
        "ppl_mean": _per_text("avg(nll)", "ppl"),
        "ppl_median": _per_text("median(nll)", "ppl"),
        "x_ppl_mean": _per_text("avg(h)", "x_ppl"),
        "x_ppl_median": _per_text("median(h)", "x_ppl"),
        "x_ppl_pad_masked": _per_text(f"avg(h) FILTER (tok NOT IN ({masked}))", "x_ppl"),
        "ppl_temperature": _per_text("avg(nll)", "ppl", TEMPERATURE),
        "x_ppl_temperature": _per_text("avg(h)", "x_ppl", TEMPERATURE),
        "x_ppl_sampled": _sampled(),
        "doc_scores": statement(f"{ROUNDED} FROM ds", "ds"),
        "doc_scores_window": statement(f"{ROUNDED} FROM dw", "dw", window),
        "score_from_metrics": statement(f"{ROUNDED} FROM ds", "ds", external),
        "self_entropy_scores": _self_entropy(),
        "logit_metrics": _logits(),
        "mode_threshold": statement(f"SELECT {K}, mode, shown, threshold, {label('score', 'threshold')} AS label "
                                    f"FROM ds CROSS JOIN ({modes})", "ds"),
        "predict_label": statement(f"SELECT {K}, {label('score', low_fpr)} AS label FROM ds", "ds"),
        "predict_binary": statement(f"SELECT {K}, CASE WHEN NOT isnan(score) AND score < {accuracy} THEN 1 ELSE 0 END "
                                    "AS pred FROM ds", "ds"),
        "gated_predict": statement(
            f"""SELECT doc_id, n_tokens, n_tokens < {MINIMUM_TOKENS} AS too_short,
                CASE WHEN n_tokens < {MINIMUM_TOKENS} THEN '' ELSE {label('score', low_fpr)} END AS label
            FROM (SELECT *, CAST(len(regexp_extract_all(lower(coalesce(text, '')), {TOKEN})) AS INTEGER) AS n_tokens
                FROM scored)""", "scored"),
        "attach_scores": statement("SELECT doc_id, file, round(score, 6) AS score FROM scored", "scored"),
        "find_missing": statement("SELECT * FROM gaps", "gaps"),
        "backfill_scores": statement(backfilled, "partly"),
        "score_counts": statement("SELECT file, count(*) FILTER (NOT isnan(score)) AS n_good, "
                                  "count(*) FILTER (isnan(score)) AS n_null FROM scored GROUP BY file", "scored"),
        "score_summary": statement(
            """SELECT file, CAST(grouping(file) AS INTEGER) AS is_total, count(DISTINCT f) AS n_files,
                count(*) AS n_rows, count(*) FILTER (NOT isnan(score)) AS n_good,
                count(*) FILTER (isnan(score)) AS n_null
            FROM (SELECT *, file AS f FROM scored) GROUP BY ROLLUP (file)""", "scored"),
        "missing_report": statement(
            """SELECT file, CAST(grouping(file) AS INTEGER) AS is_total, count(*) FILTER (scoreable) AS n_scoreable,
            count(*) FILTER (NOT scoreable) AS n_blank FROM gaps GROUP BY ROLLUP (file)""", "gaps"),
        "missing_preview": statement(
            """SELECT file, scoreable, array_to_string(list(doc_id ORDER BY doc_id)[1:20], ', ')
            || CASE WHEN count(*) > 20 THEN ', ... (+' || (count(*) - 20) || ' more)' ELSE '' END AS preview
            FROM gaps GROUP BY file, scoreable""", "gaps"),
        "scoreable_status": statement(
            f"""SELECT *, CASE WHEN n_skipped > 0 THEN 'skipping blank rows' ELSE 'good' END AS status FROM (
            SELECT file, count(*) AS n_rows, count(*) FILTER (NOT {scoreable()}) AS n_skipped
            FROM dirty GROUP BY file)""", "dirty"),
        "limit_per_file": statement(
            f"""SELECT doc_id, file, text FROM dirty
            QUALIFY row_number() OVER (PARTITION BY file ORDER BY doc_id) <= {ROWS_PER_FILE}""", "dirty"),
        "eval_table": statement("SELECT * FROM ev", "ev"),
        "confusion": statement("SELECT class, pred, count(*) AS n FROM ev GROUP BY ALL", "ev"),
        "f1": statement("SELECT round(f1, 6) AS f1, n, n_missing FROM f1s", "f1s"),
        "roc_curve": statement(f"SELECT {curve} FROM roc", "roc"),
        "roc_curve_thin": statement(
            f"""SELECT {curve} FROM (SELECT *, fp - lag(fp) OVER w AS df, tp - lag(tp) OVER w AS dt,
                lead(fp) OVER w - fp AS ef, lead(tp) OVER w - tp AS et,
                row_number() OVER w AS i, count(*) OVER () AS m FROM roc WINDOW w AS (ORDER BY threshold DESC))
            WHERE i <= 2 OR i = m OR df <> ef OR dt <> et""", "roc"),
        "roc_auc": statement(
            """SELECT round(sum((fpr - x0) * (tpr + y0) / 2e0), 6) AS auc FROM (SELECT fpr, tpr,
            lag(fpr) OVER w AS x0, lag(tpr) OVER w AS y0 FROM roc WINDOW w AS (ORDER BY threshold DESC))""", "roc"),
        "roc_auc_rank": statement(
            """SELECT round(avg(CASE WHEN m.score < h.score THEN 1e0 WHEN m.score = h.score THEN 0.5e0 ELSE 0e0 END), 6)
            AS auc FROM (SELECT score FROM ev WHERE class = 1 AND NOT isnan(score)) m
            CROSS JOIN (SELECT score FROM ev WHERE class = 0 AND NOT isnan(score)) h""", "ev"),
        "tpr_at_fpr": _tpr_at([REPORTED_FPR], "l.x"),
        "roc_log_grid": _tpr_at(list(LOG_GRID), "round(l.x, 6)"),
        "eval_metrics": _tpr_at([REPORTED_FPR], "l.x").replace("roc AS MATERIALIZED (", "f1s AS (" + STEPS["f1s"] + "),\nauc AS ("
                                                               + STEPS["auc"] + "),\nroc AS MATERIALIZED (")
        .replace("SELECT l.x AS fpr,\n", "SELECT (SELECT n FROM f1s) AS n, (SELECT n_missing FROM f1s) AS n_missing, "
                 "(SELECT round(f1, 6) FROM f1s) AS f1, (SELECT round(auc, 6) FROM auc) AS auc,\n")
        .replace("AS tpr\n        FROM l LEFT", "AS tpr_at_fpr\n        FROM l LEFT"),
        "calibrate_f1": statement(
            """SELECT threshold, round(f1, 6) AS f1 FROM (SELECT threshold,
            2 * tp / CAST(2 * tp + fp + (p - tp) AS DOUBLE) AS f1 FROM cand) ORDER BY f1 DESC, threshold LIMIT 1""",
            "cand"),
        "calibrate_fpr": statement(
            f"""SELECT {lit(REPORTED_FPR)} AS fpr_limit, n AS n_human, threshold, round(fp / CAST(n AS DOUBLE), 6) AS fpr
            FROM cand WHERE fp / CAST(n AS DOUBLE) <= {lit(REPORTED_FPR)} ORDER BY threshold DESC LIMIT 1""", "cand"),
    }
