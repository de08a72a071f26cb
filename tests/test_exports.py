"""Exports in bulk: few files for many texts, and no text parsed for a filter."""

import pytest

from fieldseries import queries_sources
from fieldseries.sources import files

SF = "/root/testdata/sf0.001"


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_many_texts_are_few_files(spark, tmp_path):
    texts = spark.range(0, 500, 1, 4).selectExpr("'key=' || id as file", "concat_ws('\n', 'Größe', id, '') as text")
    files.pack_files(texts, str(tmp_path / "packed"))
    assert len(list((tmp_path / "packed").glob("part-*"))) == 4
    assert sorted(map(tuple, files.packed_files(spark, str(tmp_path / "packed")).collect())) == sorted(map(tuple, texts.collect()))


def test_filters_do_not_parse(spark):
    f = spark.createDataFrame([("a", "title\n#,Date Time\n1,2024-01-01 00:00:00\n\n2,2024-01-02 00:00:00\n"), ("b", "nothing"), ("c", "x,date"), ("d", "u,v\n1,2\n")], "file string, text string")
    rows, errors = files.read_preamble_csv(f)
    for d in (rows, errors):
        assert not [x for x in _plan(d).splitlines() if "Filter" in x and "regexp" in x]
    assert sorted((r.file, r.line, str(r.time), sorted(r["values"].items())[0]) for r in rows.collect()) == [("a", 0, "2024-01-01 04:00:00", ("#", "1")), ("a", 1, "2024-01-02 04:00:00", ("#", "2"))]
    assert sorted(map(tuple, errors.collect())) == [("b", "no header"), ("c", "no rows"), ("d", "no time column")]


@pytest.mark.parametrize("name", ["_packed", "_written"])
def test_lines_are_sorted_without_a_lambda(spark, monkeypatch, name):
    seen = []

    def stop(session, df, *args):
        seen.append(df)
        raise InterruptedError

    monkeypatch.setattr(queries_sources, name, stop)
    with pytest.raises(InterruptedError):
        (queries_sources.read_preamble_csv if name == "_packed" else queries_sources.read_measure_report)(spark, SF)
    assert "sort_array(" in _plan(seen[0]) and "array_sort(" not in _plan(seen[0])
