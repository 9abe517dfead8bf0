import corpus_pipeline
from dwellspark.llm import decontam, neardup
from tests.llm.conftest import sentence


def test_stages_take_effect(spark, tmp_path, rng):
    langs = ["en", "de", "fr"]
    rows = [(i, sentence(rng, langs[i % 3], 60), langs[i % 3]) for i in range(60)]
    leak = " ".join(f"secret{i} item" for i in range(20))
    repeat = " ".join(f"footer{i} words" for i in range(60))
    rows += [(100, rows[0][1], "en"), (101, rows[1][1] + " more", "de"), (102, sentence(rng, "en", 80) + " " + leak, "en")]
    rows += [(103, sentence(rng, "fr", 90) + " " + repeat, "fr"), (104, sentence(rng, "fr", 90) + " " + repeat, "fr"), (105, None, "en"), (106, "12 34", "en")]
    docs = spark.createDataFrame([(i, t, lang, "s", len(t or "")) for i, t, lang in rows], "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, leak)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    now = docs
    states = {}
    for name, stage in corpus_pipeline.STAGES:
        now = stage(spark, now, str(tmp_path))
        if name != "tokens":
            assert now.columns == docs.columns
        states[name] = {r["doc_id"]: r for r in now.collect()}
    assert set(states["language"]) == {i for i, *_ in rows} - {105, 106}
    assert set(states["near_duplicates"]) == set(states["language"]) - {100, 101}
    cut = states["repeated_passages"]
    assert "footer30" not in cut[103]["text"] + cut[104]["text"] and cut[103]["n_chars"] == len(cut[103]["text"])
    assert cut[5]["text"] == rows[5][1]
    assert set(states["benchmark_leaks"]) == set(cut) - {102}
    final = sorted(map(tuple, corpus_pipeline.run(spark, str(tmp_path)).collect()))
    assert final == sorted(map(tuple, states["tokens"].values()))


def test_default_rule_is_five_words_and_four_fifths():
    assert neardup.near_duplicates.__defaults__[:2] == (5, 80) and decontam.PERCENT == 20


CLASHING = "key string, row string, own string, score string, lang_pred string, kept string, node long, ranges string, place long"


def test_stages_with_empty_tables_nulls_and_clashing_columns(spark, tmp_path, rng):
    schema = "doc_id long, text string, lang string, source string, n_chars long, " + CLASHING
    extra = ("k", "r", "o", "s", "p", "t", 5, "g", 6)
    rows = [(i, sentence(rng, "de", 40), "de", None, None, *extra) for i in range(6)]
    rows += [(7, None, None, None, None, *extra), (8, "", "de", None, 0, *extra), (None, sentence(rng, "de", 50), "de", "s", 1, *extra), rows[0]]
    docs = spark.createDataFrame(rows, schema)
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    for name, stage in corpus_pipeline.STAGES:
        now = stage(spark, docs, str(tmp_path))
        assert stage(spark, docs.limit(0), str(tmp_path)).count() == 0
        if name != "tokens":
            assert now.columns == docs.columns
            got = now.collect()
            assert {0, 1, 2, 3, 4, 5} <= {r["doc_id"] for r in got}
            assert all(tuple(r)[5:] == extra for r in got)
        else:
            assert now.count() == len(rows)


def test_passages_of_over_fifty_short_words_go(spark, tmp_path, rng):
    passage = " ".join(f"w{i}" for i in range(55))
    rows = [(i, sentence(rng, "en", 70) + "\n" + passage + "\n" + sentence(rng, "en", 70)) for i in range(3)]
    docs = spark.createDataFrame(rows + [(9, sentence(rng, "en", 70))], "doc_id long, text string")
    got = {r["doc_id"]: r["text"] for r in corpus_pipeline.repeated_passages(spark, docs, str(tmp_path)).collect()}
    assert len(passage) < 400 and got == {i: t.replace(passage, "") for i, t in rows} | {9: got[9]} and "w20" not in got[9]
