"""The corpus pipeline, stage by stage, against what each should keep."""

import corpus_pipeline
from railpulse.llm import decontaminate, ngram_join
from llm.conftest import prose

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages_keep_and_drop_what_they_should(spark, tmp_path):
    item = prose(77, 30)
    rows = [(i, prose(i, 120), "aa", "s", 0) for i in range(40)]
    rows += [(100, prose(3, 120), "aa", "s", 0), (101, "12 34", "aa", "s", 0), (102, f"{prose(500, 80)} {item}", "aa", "s", 0),
             (103, f"{prose(501, 50)} a@b.cd", "aa", "s", 0), (104, None, None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    kept = docs
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        kept = stage(spark, kept, str(tmp_path))
        seen[name] = kept.collect()
        if name != "packing":
            assert kept.columns == COLUMNS
    ids = {name: {r.doc_id for r in found} for name, found in seen.items()}
    assert ids["language"] == {r[0] for r in rows} - {101, 104}
    assert ids["ngram_join"] == ids["language"] - {100}
    assert ids["decontamination"] == ids["ngram_join"] - {102} == ids["pii"] == ids["packing"]
    assert next(r.text for r in seen["pii"] if r.doc_id == 103).endswith(" [email]")
    whole = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert sorted(map(str, whole)) == sorted(map(str, seen["packing"]))


def test_items_are_found_under_null_and_repeated_ids(spark, documents):
    item = prose(77, 30)
    dirty, clean = f"{prose(500, 80)} {item}", prose(3, 90)
    rows = [(None, dirty), (None, clean), (None, None), (1, dirty), (1, clean), (2, dirty), (2, dirty), (3, clean), (3, clean)]
    items = spark.createDataFrame([(1, item)], "item_id long, text string")
    docs = documents(rows)
    kept = decontaminate.decontaminated(docs, items)
    assert kept.columns == docs.columns
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=str) == sorted(
        [(None, clean), (None, None), (3, clean), (3, clean)], key=str)


def test_repeated_rows_stay_once(documents):
    one, two, three = prose(1, 90), prose(2, 90), prose(4, 90)
    rows = [(1, one, "b"), (1, one, "a"), (1, one, "a"), (1, two), (2, one), (3, None), (3, None), (4, None), (None, three),
            (None, three), (None, one), (6, prose(5, 90)), (7, prose(5, 90) + " x")]
    docs = documents(rows)
    kept = ngram_join.one_of_each(docs)
    assert kept.columns == docs.columns
    assert sorted(((r.doc_id, r.text, r.lang) for r in kept.collect()), key=str) == sorted(
        [(1, one, "a"), (1, two, None), (3, None, None), (4, None, None), (None, three, None), (None, one, None),
         (6, prose(5, 90), None)], key=str)


def test_repeated_rows_are_compared_once(documents, monkeypatch):
    compared, families_of = [], ngram_join.families_of

    def counted(ones):
        compared.append(ones.count())
        return families_of(ones)

    monkeypatch.setattr(ngram_join, "families_of", counted)
    text = prose(1, 90)
    found = ngram_join.near_duplicates(documents([(1, text)] * 5 + [(2, text + " more"), (3, prose(2, 90))])).collect()
    assert compared == [3]
    assert sorted((r.doc_id, r.component_id) for r in found) == [(1, 1)] * 5 + [(2, 1), (3, 3)]
