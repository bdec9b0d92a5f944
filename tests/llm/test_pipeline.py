"""Registered queries against their SQL, and the pipeline against stages done by hand."""

import pytest

import __spark_entry__ as E
import corpus_pipeline as P

from tools.check_oracle import rows_of, type_diffs
from tollgate.llm import decontaminate, langid, lines, mixing, quality, queries, simhash  # noqa: F401
from tollgate.llm.common import write_table


SF_MID = "/root/testdata/sf0.01"


def test_names():
    names = [f"op{n}_" for n in range(1, 11)]
    assert all(sum(k.startswith(n) for k in E.queries()) == 1 for n in names) and "pipeline" in E.queries()


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query_equals_sql(spark, duck, name):
    df = E.queries()[name](spark, SF_MID)
    rel = duck(SF_MID).sql(E.oracle_sql()[name])
    assert sorted(df.columns) == sorted(rel.columns) and type_diffs(df.schema, rel) == []
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == rows_of(rel.columns, rel.fetchall())


def test_pipeline_equals_its_stages_by_brute_force(spark):
    from test_decontaminate import distance_in  # noqa: F401  (same folder)
    from test_lines import brute as kept_lines
    from test_mixing import brute as mixed
    from test_simhash import brute_fingerprint, classes
    sf = SF_MID
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = {r.doc_id: r for r in docs.collect()}
    model = quality.train(docs, spark.read.parquet(f"{sf}/labels.parquet"))
    kept = {i: r.text for i, r in rows.items()
            if model.score(quality.text_features(r.text), quality.metadata_features(r.source, r.lang, len(r.text)))[0] >= quality.KEEP_FROM}
    stays = kept_lines(list(kept.items()), lines.MIN_CHARS)
    texts = {i: "\n".join(stays[i]) for i in kept}
    prints = {i: brute_fingerprint(t) for i, t in texts.items()}
    values = sorted(set(prints.values()))
    same = classes([(a, b) for k, a in enumerate(values) for b in values[k + 1:] if (a ^ b).bit_count() <= 3], values)
    first = {}
    for i, f in prints.items():
        first[same[f]] = min(first.get(same[f], i), i)
    texts = {i: texts[i] for i in first.values()}
    items = [D for D in (decontaminate.normal(r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect())]

    def occurs(item, text):                                  # every place, not only those near a piece
        limit = decontaminate.budget(len(item))
        return decontaminate.least_distance(decontaminate.letters(item), len(item), text, limit)[0] <= limit
    texts = {i: t for i, t in texts.items() if not any(x in (n := decontaminate.normal(t)) for x in items)
             and (i % 10 or not any(occurs(x, n) for x in items[:10]))}
    _, want = mixed([(i, rows[i].source, len(t.encode().split())) for i, t in texts.items()],
                    mixing.TARGET_ENTROPY, mixing.MAX_REPEATS, mixing.BUDGET, mixing.BLOCK_TOKENS)
    got = P.run(spark, sf)
    found = got.collect()
    assert sorted(((r.doc_id, r.epoch, r.block) for r in found), key=repr) == want
    assert all(r.text == texts[r.doc_id] and r.n_chars == len(r.text) for r in found)


def test_pipeline_on_odd_tables(spark, make_docs, tmp_path):
    docs = make_docs([(1, None, None, None, "x"), (2, "", "en", "a", "y"), (2, "", "en", "a", "y"), (None, "some words in a text", "en", "a", "z"),
                      (4, "long " * 30_000, "en", "b", None)], ", row string")
    for name, table in (("documents", docs), ("labels", spark.createDataFrame([], "doc_id long, quality int, toxic int")),
                        ("benchmark", spark.createDataFrame([], "item_id long, text string"))):
        table.write.parquet(str(tmp_path / f"{name}.parquet"))
    got = docs
    for name, stage in P.STAGES:
        got = write_table(stage(spark, got, str(tmp_path)), "odd")
        if name != P.STAGES[-1][0]:
            assert got.columns == docs.columns
    # the small source is repeated up to its limit, the empty texts have left the mix
    assert {(r.doc_id, r.row) for r in got.collect()} == {(4, None), (None, "z")}
    empty = docs.limit(0)
    for _, stage in P.STAGES:
        empty = write_table(stage(spark, empty, str(tmp_path)), "none")
    assert empty.count() == 0
