"""The pipeline's stages one by one on the small tables, each against what it got."""

import zlib
from collections import Counter

import corpus_pipeline


def test_stages(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").cache()
    columns = docs.columns
    first = {r.doc_id: r for r in docs.collect()}
    clean = corpus_pipeline.stage_toxicity(spark, docs, sf).cache()
    kept = {r.doc_id: r for r in clean.collect()}
    seen_labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf}/labels.parquet").collect() if r.doc_id in first and zlib.crc32(str(r.doc_id).encode()) % 5}
    lost = set(first) - set(kept)
    assert clean.columns == columns and len(lost) < 0.3 * len(first)  # 68 labels teach no more than themselves
    assert {i for i, t in seen_labels.items() if t} <= lost and sum(i in lost for i, t in seen_labels.items() if not t) <= 3
    assert all(r == first[i] for i, r in kept.items())
    lines = corpus_pipeline.stage_line_dedup(spark, clean, sf).cache()
    after = {r.doc_id: r for r in lines.collect()}
    assert lines.columns == columns and set(after) <= set(kept) and all(r.n_chars == len(r.text) for r in after.values() if r.text != kept[r.doc_id].text)
    seen = Counter(x for r in after.values() for x in set(r.text.split("\n")) if len(x.split()) >= 40)
    assert not seen or max(seen.values()) == 1
    near = corpus_pipeline.stage_near_duplicates(spark, lines, sf).cache()
    single = {r.doc_id: r for r in near.collect()}
    assert near.columns == columns and set(single) <= set(after)
    mixed = corpus_pipeline.stage_mixing(spark, near, sf).cache()
    some = {r.doc_id for r in mixed.collect()}
    assert mixed.columns == columns and some <= set(single) and len(some) > 0.3 * len(single)
    packed = corpus_pipeline.stage_packing(spark, mixed, sf).collect()
    assert {r.doc_id for r in packed} == some and all(0 < r.length <= 2048 and 0 <= r.ids_crc32 < 2**32 for r in packed)


def test_names():
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "line_dedup", "near_duplicates", "mixing", "packing"]
    assert corpus_pipeline.ORACLE_SQL is None


LINES = "\n".join(f"line {k} " + " ".join(f"w{k}x{j}" for j in range(12)) + "." for k in range(8))
PLAIN = " ".join(f"p{j}" for j in range(90))
ROWS = [
    (1, PLAIN, "en", "a"),
    (1, PLAIN, "en", "a"),  # a repeated row
    (2, None, None, None),
    (3, "", "en", "a"),
    (None, PLAIN + " more", "en", "b"),  # a near copy without an id
    (None, "text of its own without an id", None, "b"),
    (None, "text of its own without an id", None, "b"),
    (None, None, "en", None),
    (5, LINES, "en", "a"),
    (6, LINES + "\nown line here.", "en", "a"),
    (7, "word " * 40_000, "en", "a"),
    (8, " \t\n ", "en", "a"),
    (9, "one id, two texts", "en", "a"),
    (9, "another text of it", "en", "a"),
]
EXTRA = "score double, _score double, _deleted_lines string, _n_lines long, _sampled string, _topic long, _tokens long, __d long, __key string, `a.b` string"


def odd(spark, rows):
    ddl = "doc_id long, text string, lang string, source string, n_chars long, " + EXTRA
    return spark.createDataFrame([(i, t, lang, s, -1, 0.1, 0.2, "del", 4, "samp", 5, 6, 7, "k", "dot") for i, t, lang, s in rows], ddl)


def test_stages_on_odd_rows(spark, sf):
    """Nulls anywhere, empty and long texts, repeated rows, rows without an id, extra columns with any name."""
    docs = odd(spark, ROWS)
    extra = tuple(docs.first())[5:]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, sf)
        got = out.collect()
        assert out.columns == docs.columns and all(tuple(r)[5:] == extra for r in got), name
        assert stage(spark, odd(spark, []), sf).collect() == [], name
        texts = Counter((r.doc_id, r.text) for r in got)
        if name == "toxicity":
            assert all(texts[(i, t)] == n for (i, t), n in Counter(r[:2] for r in ROWS).items() if not (t or "").strip())
        elif name == "line_dedup":
            assert texts[(6, "own line here.")] == 1 and texts[(5, LINES)] == 1 and texts[(1, PLAIN)] == 2 and texts[(2, None)] == texts[(3, "")] == 1
            assert {r.n_chars for r in got} == {-1, len("own line here.")}
        elif name == "near_duplicates":
            assert texts[(1, PLAIN)] == 1 and texts[(None, PLAIN + " more")] == 0 and texts[(None, "text of its own without an id")] == 1
            assert texts[(9, "one id, two texts")] == texts[(9, "another text of it")] == texts[(2, None)] == texts[(None, None)] == texts[(3, "")] == texts[(8, " \t\n ")] == 1
            assert texts[(5, LINES)] + texts[(6, LINES + "\nown line here.")] == 1
        else:
            assert set(texts) <= {r[:2] for r in ROWS} and len(got) > 0
    packed = corpus_pipeline.stage_packing(spark, docs, sf).collect()
    assert Counter(r.doc_id for r in packed if r.piece == 0) == Counter(r[0] for r in ROWS)
    assert corpus_pipeline.stage_packing(spark, odd(spark, []), sf).collect() == []


def test_run_leaves_only_what_the_result_reads(spark, sf):
    from kalends.llm.common import written

    before = set(written())
    out = corpus_pipeline.run(spark, sf)
    assert out.count() > 0 and 1 <= len(set(written()) - before) <= 6
