import contextlib
import json
import math
import os

import pandas as pd
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from perplexis.operators import missing as G
from perplexis.plans.experiment import run_experiment
from perplexis.plans.providers import ArrowModels
from perplexis.plans.scoring import Scorer
from perplexis.sources import committer, files

WORDS = "the cat sat on a mat while that dog ran off with my hat".split()


def base(path):
    return path and os.path.basename(path)


def sentence(i, length=30):
    return " ".join(WORDS[(i * 7 + j * (i % 3 + 1)) % len(WORDS)] for j in range(length))


@pytest.fixture(scope="module")
def scorer(spark):
    corpus = spark.createDataFrame([(i, sentence(i)) for i in range(40)], "id long, text string")
    return Scorer.train(corpus, F.col("id") < 25, F.lit(True))


@pytest.fixture
def folder(spark, tmp_path):
    """Two input files, an earlier output, and a nested file that isn't an input."""
    rows = {
        "b.parquet": [(1, sentence(1)), (2, None), (3, " \t"), (4, "!!!"), (5, sentence(5))],
        "a.parquet": [(6, sentence(6)), (7, sentence(7))],
        "a_scored.parquet": [(6, sentence(6))],
        "nested/c.parquet": [(8, sentence(8))],
    }
    for name, content in rows.items():
        path = tmp_path / "in" / name
        os.makedirs(path.parent, exist_ok=True)
        spark.createDataFrame(content, "id long, text string").toPandas().to_parquet(path, index=False)
    return str(tmp_path / "in")


def test_inputs(spark, folder):
    names = lambda paths: [p.rsplit("/", 1)[1] for p in paths]
    assert names(files.collect_inputs(spark, [folder])) == ["a.parquet", "b.parquet"]
    assert names(files.collect_inputs(spark, [folder], include_outputs=True)) == [
        "a.parquet", "a_scored.parquet", "b.parquet"
    ]
    given = [f"{folder}/b.parquet", f"{folder}/nested"]
    assert names(files.collect_inputs(spark, given)) == ["b.parquet", "c.parquet"]
    counts = files.count_rows(spark, files.collect_inputs(spark, [folder])).collect()
    assert {os.path.basename(r.file): r.n_rows for r in counts} == {"a.parquet": 2, "b.parquet": 5}


def listing(folder):
    """Content and time of every Parquet file, to tell what was written again."""
    return {n: (os.path.getmtime(f"{folder}/{n}"), os.path.getsize(f"{folder}/{n}")) for n in os.listdir(folder) if n.endswith(".parquet")}


def lose_scores(spark, folder, lost):
    """Sets scores in place: ``lost`` maps ids to what they become."""
    for name in listing(folder):
        table = pq.read_table(f"{folder}/{name}")
        ids = table["id"].to_pylist()
        if set(lost) & set(ids):
            scores = [lost.get(i, s) for i, s in zip(ids, table["score"].to_pylist(), strict=True)]
            table = table.set_column(table.schema.get_field_index("score"), "score", pa.array(scores, pa.float64()))
            pq.write_table(table, f"{folder}/{name}")
            if os.path.exists(f"{folder}/.{name}.crc"):
                os.remove(f"{folder}/.{name}.crc")


def test_score_files_and_fill_gaps(spark, scorer, folder, tmp_path):
    out = str(tmp_path / "out")
    written = scorer.score_files([folder], out)
    assert sorted(listing(out)) == ["a_scored.parquet", "b_scored.parquet"]
    rows = {r.id: r for r in written.table.collect()}
    assert sorted(rows) == [1, 2, 3, 4, 5, 6, 7]
    assert {i for i, r in rows.items() if math.isnan(r.score)} == {2, 3, 4}
    assert rows[3].text == " \t" and rows[2].text is None and rows[1].row_id == 0
    assert pd.read_parquet(f"{out}/b_scored.parquet").columns.tolist() == ["id", "text", "score"]
    assert pd.read_parquet(f"{out}/b_scored.parquet").id.tolist() == [1, 2, 3, 4, 5]
    summary = {base(r.path): r for r in written.summary.collect()}
    assert tuple(summary["b.parquet"])[1:] == (0, 1, 5, 2, 3) and tuple(summary[None])[1:] == (1, 2, 7, 4, 3)

    # Lose scores of one file, in a way that shows which files are written again.
    lose_scores(spark, out, {1: math.nan, 5: None})
    before = listing(out)
    report = {base(r.file): r for r in scorer.score_missing(out, dry_run=True).collect()}
    assert (report["b_scored.parquet"].n_scoreable, report["b_scored.parquet"].n_blank) == (3, 2)
    assert (report[None].n_scoreable, report[None].is_total) == (3, 1) and "a_scored.parquet" not in report
    assert listing(out) == before

    scorer.score_missing(out)
    filled = {r.id: r for r in spark.read.parquet(out).collect()}
    assert listing(out)["a_scored.parquet"] == before["a_scored.parquet"]
    for i, r in rows.items():
        assert filled[i].score == pytest.approx(r.score, nan_ok=True) and filled[i].text == r.text
    # Filling again writes nothing: only a text without tokens is still missing.
    before = listing(out)
    again = {base(r.file): r for r in scorer.score_missing(out).collect()}
    assert again["b_scored.parquet"].n_scoreable == 1 and listing(out) == before


def test_outputs_beside_inputs_and_later_runs(spark, scorer, folder, tmp_path):
    """A second run reads only files that are new or have changed."""
    first = scorer.score_files([folder])
    assert sorted(listing(folder)) == ["a.parquet", "a_scored.parquet", "b.parquet", "b_scored.parquet"]
    assert sorted(map(base, files.collect_inputs(spark, [folder]))) == ["a.parquet", "b.parquet"]
    assert len(first.outputs) == 2
    times = listing(folder)
    again = scorer.score_files([folder])
    assert again.outputs == [] and tuple(again.summary.first())[1:] == (1, 0, 0, 0, 0) and listing(folder) == times
    pd.DataFrame({"id": [10], "text": [sentence(4)]}).to_parquet(f"{folder}/new.parquet", index=False)
    pd.DataFrame({"id": [6, 7, 8], "text": [sentence(6), sentence(7), sentence(8)]}).to_parquet(f"{folder}/a.parquet", index=False)
    third = scorer.score_files([folder])
    assert sorted(map(base, third.outputs)) == ["a_scored.parquet", "new_scored.parquet"]
    assert listing(folder)["b_scored.parquet"] == times["b_scored.parquet"]
    assert sorted(r.id for r in third.table.collect()) == [6, 7, 8, 10]
    assert len(scorer.score_files([folder], again=True).outputs) == 3
    # What was done with other options is no reason to pass a file over.
    assert sorted(r.id for r in scorer.score_files([folder], limit=1).table.collect()) == [1, 6, 10]
    assert len(scorer.score_files([folder], limit=1).outputs) == 0


def test_limit_counts_rows_of_each_file(spark, scorer, folder, tmp_path):
    scored = scorer.score_files([folder], str(tmp_path / "few"), limit=1)
    assert sorted(r.id for r in scored.table.collect()) == [1, 6]
    assert tuple(scored.summary.where("is_total = 1").first())[2:] == (2, 2, 2, 0)
    with pytest.raises(ValueError, match="no Parquet file"):
        scorer.score_files([f"{folder}/a_scored.parquet"], str(tmp_path / "none"))


def test_files_of_odd_names_and_none_rows(spark, scorer, tmp_path):
    """Long and strange paths, and a file without rows, which gets an output of its columns."""
    place = tmp_path / ("d" * 200) / "a b%20c=ü+#" / ("e" * 90)
    os.makedirs(place)
    pd.DataFrame({"id": [1, 2], "text": [sentence(1), sentence(2)]}).to_parquet(place / "é f%.parquet", index=False)
    pq.write_table(pa.table({"id": pa.array([], pa.int64()), "text": pa.array([], pa.string())}), place / "none.parquet")
    written = scorer.score_files([str(place)])
    assert sorted(n for n in os.listdir(place) if n[0] != ".") == sorted([committer.WORK_FOLDER, "none.parquet", "none_scored.parquet", "é f%.parquet", "é f%_scored.parquet"])
    assert pd.read_parquet(place / "none_scored.parquet").columns.tolist() == ["id", "text", "score"]
    assert [r.score for r in written.table.orderBy("id").collect()] == pytest.approx(scorer.score_literal([sentence(1), sentence(2)]))


def test_large_files_and_many_waves(spark, scorer, tmp_path, monkeypatch):
    """Waves of few rows, and files of more rows than a wave, give the same as one wave."""
    os.makedirs(tmp_path / "in")
    for n in range(5):
        rows = [(100 * n + i, sentence(n + i)) for i in range(3 + 9 * (n == 2))]
        pd.DataFrame(rows, columns=["id", "text"]).to_parquet(tmp_path / "in" / f"f{n}.parquet", index=False)
    whole = scorer.score_files([str(tmp_path / "in")], str(tmp_path / "whole"))
    monkeypatch.setattr(files, "WAVE_ROWS", 6)
    assert [len(g) for g in files.waves([("a", 3), ("b", 3), ("c", 12), ("d", 3), ("e", 3)], 6)] == [2, 1, 2]
    parts = scorer.score_files([str(tmp_path / "in")], str(tmp_path / "parts"))
    for n in range(5):
        left, right = (pd.read_parquet(tmp_path / f / f"f{n}_scored.parquet") for f in ("whole", "parts"))
        assert left.id.tolist() == right.id.tolist() and left.score.tolist() == pytest.approx(right.score.tolist())
    assert {tuple(r)[1:] for r in whole.summary.collect()} == {tuple(r)[1:] for r in parts.summary.collect()}


def test_no_text_is_shuffled_to_be_written(spark, scorer, folder, tmp_path, monkeypatch):
    plans = []
    original = files.with_values

    def watched(texts, values, gathered):
        joined = original(texts, values, gathered)
        plans.append(joined._jdf.queryExecution().executedPlan().toString())
        return joined

    monkeypatch.setattr(files, "with_values", watched)
    scorer.score_files([folder], str(tmp_path / "out"))
    assert len(plans) == 1 and "BroadcastHashJoin" in plans[0]
    assert "Exchange hashpartitioning" not in plans[0] and "RoundRobin" not in plans[0]


def test_interrupted_moves_are_finished(spark, scorer, folder, tmp_path, monkeypatch):
    """A run that stops between its steps is completed by the next, or leaves nothing."""
    out = str(tmp_path / "out")
    scorer.score_files([folder], out)
    expected = {r.id: r.score for r in spark.read.parquet(out).collect()}
    for stop in range(5):
        lose_scores(spark, out, {1: math.nan, 6: math.nan})
        steps = []

        def failing(self, source, target, original=committer.Store.move):
            steps.append(target)
            if len(steps) > stop:
                raise KeyboardInterrupt
            original(self, source, target)

        monkeypatch.setattr(committer.Store, "move", failing)
        with pytest.raises(KeyboardInterrupt) if stop < 3 else contextlib.nullcontext():
            scorer.score_missing(out)
        monkeypatch.undo()
        # No file is half written, whatever was reached: moves begin once the journal is there.
        left = [n for n in os.listdir(f"{out}/{committer.WORK_FOLDER}/journal") if n.endswith(".json")]
        assert len(left) == (0 < stop < 3)
        assert files.finish_interrupted(spark, out) == len(left)
        found = {r.id: r.score for r in spark.read.parquet(out).collect()}
        if stop:
            assert found == pytest.approx(expected, nan_ok=True)
        else:
            assert sorted(i for i, s in found.items() if math.isnan(s)) == [1, 2, 3, 4, 6]
        assert not [n for n in os.listdir(f"{out}/{committer.WORK_FOLDER}") if n.startswith("staging")]


def test_file_without_the_column_is_named(spark, scorer, folder, tmp_path):
    pd.DataFrame({"id": [1], "body": ["no text"]}).to_parquet(f"{folder}/odd.parquet", index=False)
    pd.DataFrame({"id": [1], "text": [None]}, dtype="object").astype({"id": "int64", "text": "str"}).to_parquet(f"{folder}/blank.parquet", index=False)
    with pytest.raises(ValueError, match="no column 'text' in .*odd.parquet"):
        scorer.score_files([folder], str(tmp_path / "out"))
    assert not os.path.exists(tmp_path / "out") or listing(str(tmp_path / "out")) == {}


def test_texts_of_one_key_are_told(spark, scorer):
    texts = spark.createDataFrame([(1, sentence(1)), (1, sentence(2)), (2, sentence(3))], "id long, text string")
    with pytest.raises(Exception, match="Several texts have the key 1"):
        scorer.score(texts, ["id"]).collect()
    assert scorer.score(texts.where("id = 2"), ["id"]).count() == 1


# Any other pair of models

def toy_values(batches, max_tokens):
    """Surprise by the length of words, as if two models had said so."""
    for batch in batches:
        keys = [n for n in batch.schema.names if n != "text"]
        out = {n: [] for n in [*keys, "pos", "tok", "nll", "h"]}
        for row in batch.to_pylist():
            words = row["text"].split()[:max_tokens]
            for i, word in enumerate(words):
                for key in keys:
                    out[key].append(row[key])
                out["pos"].append(i + 1)
                out["tok"].append(word)
                out["nll"].append(float(len(words[i + 1])) if i + 1 < len(words) else None)
                out["h"].append(float(len(word)))
        types = {n: batch.schema.field(n).type for n in keys} | {"pos": pa.int32(), "tok": pa.string(), "nll": pa.float64(), "h": pa.float64()}
        yield pa.RecordBatch.from_arrays([pa.array(out[n], types[n]) for n in out], names=list(out))


def toy_score(text, n=None):
    words = text.split()[:n]
    return (sum(map(len, words[1:])) / (len(words) - 1)) / (sum(map(len, words)) / len(words))


@pytest.fixture(scope="module")
def vocabulary(spark):
    return spark.createDataFrame([("a", 1), ("b", 2)], "tok string, id long")


def test_other_models_score_files_and_run_experiments(spark, vocabulary, folder, tmp_path):
    toy = Scorer(ArrowModels(toy_values, vocabulary, vocabulary), max_tokens=9)
    assert toy.score_literal(sentence(3)) == pytest.approx(toy_score(sentence(3), 9))
    rows = {r.id: r.score for r in toy.score_files([folder], str(tmp_path / "out")).table.collect()}
    for i in (1, 5, 6, 7):
        assert rows[i] == pytest.approx(toy_score(sentence(i), 9))
    assert math.isnan(rows[2]) and math.isnan(rows[3])
    with open(tmp_path / "pairs.jsonl", "w") as f:
        for i in range(12):
            f.write(json.dumps({"text": f"{'x' * (i + 9)} y y y", "model_generated_text": f"y y {'x' * (i + 2)} {'x' * (i + 9)}"}) + "\n")
    record = run_experiment(toy, str(tmp_path / "pairs.jsonl"), "text", results=str(tmp_path / "r"), calibrate="f1").first()
    assert record.n == 24 and record.calibrated_by == "f1" and record.auc in (0.0, 1.0) and 0 < record.f1 <= 1


def test_models_are_checked(spark, vocabulary, folder, tmp_path):
    other = spark.createDataFrame([("a", 1), ("b", 3)], "tok string, id long")
    with pytest.raises(ValueError, match="vocabularies differ"):
        ArrowModels(toy_values, vocabulary, other)

    def lacking(batches, max_tokens):
        return (b.drop_columns(["h"]) for b in toy_values(batches, max_tokens))

    def wrong(batches, max_tokens):
        for b in toy_values(batches, max_tokens):
            yield b.set_column(b.schema.get_field_index("h"), "h", b.column("h").cast(pa.float32()))

    for values, message in ((lacking, "must yield the columns"), (wrong, "'h' must be double")):
        with pytest.raises(Exception, match=message):
            Scorer(ArrowModels(values, vocabulary, vocabulary)).score_literal("a b c")


def test_missing_columns(spark, scorer, folder, tmp_path):
    with pytest.raises(ValueError, match="There is no column"):
        scorer.score_files([folder], str(tmp_path / "x"), text="body")
    with pytest.raises(ValueError, match="scoring the texts adds it"):
        scorer.score_missing(f"{folder}/a.parquet")


def test_literals_and_modes(spark, scorer):
    one = scorer.score_literal(sentence(3))
    several = scorer.score_literal([sentence(3), "", "word"])
    assert one == pytest.approx(several[0]) and math.isnan(several[1]) and math.isnan(several[2])
    low = scorer.with_threshold(one)
    assert low.predict_literal(sentence(3)) == "Most likely human-generated"
    assert scorer.with_threshold(one * 1.01).predict_literal([sentence(3)]) == ["Most likely AI-generated"]
    assert scorer.with_mode("accuracy").threshold > scorer.with_mode("low-fpr").threshold
    with pytest.raises(ValueError, match="There is no mode"):
        scorer.with_mode("none")


def test_window_limits_what_is_seen(spark, scorer):
    from dataclasses import replace
    texts = [sentence(3), sentence(3) + " unseen words at the end"]
    short = replace(scorer, max_tokens=30).score_literal(texts)
    assert short[0] == pytest.approx(short[1])
    whole = replace(scorer, max_tokens=None).score_literal(texts)
    assert whole[0] != pytest.approx(whole[1])


def test_reports(spark):
    nan = math.nan
    rows = [("f", i, "word", nan) for i in range(25)] + [("f", 30, " ", nan), ("g", 1, "a", 0.5), ("h", 2, "", None)]
    scored = spark.createDataFrame(rows, "file string, id long, text string, score double")
    counts = {r.file: (r.n_good, r.n_null) for r in G.score_counts(scored).collect()}
    assert counts == {"f": (0, 26), "g": (1, 0), "h": (0, 1)}
    total = G.score_summary(scored).where("is_total = 1").first()
    assert (total.n_files, total.n_rows, total.n_good, total.n_null) == (3, 28, 1, 27)
    report = {r.file: (r.n_scoreable, r.n_blank) for r in G.missing_report(scored).collect()}
    assert report == {"f": (25, 1), "h": (0, 1), None: (25, 2)}
    preview = {(r.file, r.scoreable): r.preview for r in G.missing_preview(scored, "id").collect()}
    assert preview["f", True] == ", ".join(map(str, range(20))) + ", ... (+5 more)"
    assert preview["f", False] == "30"
    status = {r.file: (r.n_rows, r.n_skipped, r.status) for r in G.scoreable_status(scored).collect()}
    assert status["f"] == (26, 1, "skipping blank rows") and status["g"] == (1, 0, "good")
    limited = G.limit_per_file(scored, 3, ["id"])
    assert sorted((r.file, r.id) for r in limited.collect()) == [("f", 0), ("f", 1), ("f", 2), ("g", 1), ("h", 2)]
    assert G.limit_per_file(scored, 0, ["id"]).count() == 28
    whole = sorted(tuple(r)[:2] for r in limited.collect())
    pieces, G.ROWS_PER_RANGE = G.ROWS_PER_RANGE, 5
    try:
        assert sorted(tuple(r)[:2] for r in G.limit_per_file(scored, 3, ["id"]).collect()) == whole
    finally:
        G.ROWS_PER_RANGE = pieces
    for report_of in (G.score_summary(scored), G.missing_report(scored)):
        assert "Expand" not in report_of._jdf.queryExecution().toString()


def test_experiment(spark, scorer, tmp_path):
    path = tmp_path / "core" / "news" / "pairs.jsonl"
    os.makedirs(path.parent)
    key = "maker_generated_text_wo_prompt"
    with open(path, "w") as f:
        for i in range(30):
            f.write(json.dumps({"text": f"{sentence(i)} odd{i} new{i}", key: sentence(i)}) + "\n")
    results = str(tmp_path / "results")
    record = run_experiment(scorer.with_window(512), str(path), "text", results=results).first()
    assert record.threshold == 0.9015310749276843 and record.calibrated_by is None
    assert record.dataset_name == "news" and record.machine_sample_key == key
    assert record.machine_text_source == "maker_generated_text_wo_prompt".rstrip("_generated_text_wo_prompt")
    assert record.job_name == f"news-{record.machine_text_source}-512-tokens"
    assert record.n == 60 and record.auc > 0.9 and "ROC AUC" in record.summary
    scores = spark.read.option("header", True).csv(f"{results}/{record.job_name}/scores")
    assert scores.columns == ["score", "class", "pred"] and scores.count() == 60
    assert not spark.read.parquet(f"{results}/{record.job_name}/roc").isEmpty()
    low = run_experiment(scorer, str(path), "text", results=results, job_name="low", calibrate="fpr").first()
    assert low.calibrated_by == "fpr" and low.threshold != record.threshold
    set_one = run_experiment(scorer.with_threshold(0.5), str(path), "text", results=results, job_name="set").first()
    assert set_one.threshold == 0.5
    with pytest.raises(ValueError, match="one way to calibrate"):
        run_experiment(scorer, str(path), "text", results=results, threshold=0.5, calibrate="f1")


def test_files_of_equal_name_and_mixed_columns(spark, tmp_path, scorer):
    """A file is its path; scoring again replaces the score; columns of all files stay."""
    texts = {"a": ["one two three", "two two one"], "b": ["three one two two", "one"]}
    for folder, rows in texts.items():
        table = spark.createDataFrame([(t, folder, 5.0, "mine") for t in rows], f"text string, only_{folder} string, score double, file string")
        table.coalesce(1).write.parquet(str(tmp_path / folder))
    files = [p for f in texts for p in (tmp_path / f).glob("*.parquet")]
    paths = []
    for folder, path in zip(texts, files, strict=True):
        (tmp_path / "in" / folder).mkdir(parents=True)
        paths.append(str(path.rename(tmp_path / "in" / folder / "x.parquet")))
    rows = scorer.score_files(paths, str(tmp_path / "out")).table.collect()
    assert len(listing(str(tmp_path / "out"))) == 2
    expected = dict(zip(sum(texts.values(), []), scorer.score_literal(sum(texts.values(), [])), strict=True))
    assert len(rows) == 4 and len({r.file for r in rows}) == 2
    for r in rows:
        assert (r.score == expected[r.text]) or (math.isnan(r.score) and math.isnan(expected[r.text]))
        assert r.given_file == "mine" and (r.only_a is None) != (r.only_b is None)
    assert "file" in pd.read_parquet(rows[0].file.removeprefix("file:")).columns


def test_null_conditions_and_null_order_lose_no_row(spark):
    from perplexis.operators.model import count_pairs
    from perplexis.operators.running import row_numbers

    toks = spark.createDataFrame([(["a", "b"], "base"), (["c", "d"], None)], "tokens array<string>, src string")
    counted = count_pairs(toks, F.col("src") == "base", F.lit(True)).agg(F.sum("n_p"), F.sum("n_q")).first()
    assert tuple(counted) == (2, 4)
    rows = spark.createDataFrame([(1, "x"), (None, "x"), (2, None)], "k long, g string")
    assert sorted(r.row_number for r in row_numbers(rows, ["k"], ["g"]).collect()) == [1, 1, 2]


def test_tables_of_a_finished_job_are_cleared(spark, tmp_path):
    from perplexis.sources.workspace import cleared, stored

    with cleared(spark):
        inner = stored(spark.range(3), "passing").inputFiles()[0].removeprefix("file:").rsplit("/", 1)[0]
        kept = stored(spark.range(4), "kept", str(tmp_path / "kept"))
        assert os.path.exists(inner)
    assert not os.path.exists(inner) and kept.count() == 4
    assert stored(spark.range(5), "outside").count() == 5
