from __future__ import annotations

from ledgerline.llm import licenses


def test_whole_texts_match_in_any_spelling(spark, docs_of):
    mit, bsd = licenses.KNOWN["MIT"], licenses.KNOWN["BSD-2-Clause"]
    head, rest = mit.split("\n\n", 1)
    rows = [
        (1, mit), (2, mit.upper()), (3, f"{head}\n\nCopyright (c) 2020 Jane Doe\n\n{rest}"), (4, f"# {head}\n# (c) me\n#\n" + "\n".join("# " + x for x in rest.split("\n"))),
        (5, mit.replace('"', "”").replace("sublicense", "sub-license")), (6, mit + " extra"), (7, mit[:-20]), (8, None), (9, ""), (10, "  \n!!"),
        (11, "© 2021 A. N. Other. All rights reserved.\n" + bsd), (12, bsd.replace("MERCHANTABILITY", "MERCHANTABILITIES")),
        (13, licenses.KNOWN["Zlib"].replace("acknowledgment", "acknowledgement")), (14, "released under the mit licence"), (14, "released under the mit licence"),
        (15, mit * 40), (None, licenses.KNOWN["ISC"])]
    df = docs_of(rows).withColumnRenamed("n", "license_id")
    got = licenses.scan(df)
    assert got.columns == ["doc_id", "text", "_key", "_text", "canonical_sha256", "license_id"]
    found = sorted((str(r.doc_id), r.license_id) for r in got.collect())
    want = {1: "MIT", 2: "MIT", 3: "MIT", 4: "MIT", 5: "MIT", 11: "BSD-2-Clause", 13: "Zlib", 14: "MIT-notice", None: "ISC"}
    assert found == sorted((str(i), want.get(i)) for i, _ in rows)
    assert licenses.scan(docs_of([])).collect() == []


def test_registry_is_a_parameter_and_ties_go_to_the_first_id(spark, docs_of, monkeypatch):
    registry = spark.createDataFrame([("B", "My  Licence"), ("A", "my license!"), ("C", "..."), ("D", None)], "license_id string, text string")
    for rows in (0, 100):
        monkeypatch.setattr(licenses, "BROADCAST_ROWS", rows)
        assert [r.license_id for r in licenses.scan(docs_of([(1, "MY LICENSE"), (2, "")]), registry).orderBy("doc_id").collect()] == ["A", None]


def test_plan_has_no_python(spark, docs_of):
    plan = licenses.scan(docs_of([(1, "x")]))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
