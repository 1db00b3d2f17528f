"""op3_line_quality against its SQL on documents where its line limit takes effect."""

from __future__ import annotations

import duckdb

from stratalake.llm.queries import ORACLES, QUERIES


def test_a_large_host_does_not_shelter_its_lines(spark, tmp_path):
    line = "share this page with all of your friends"
    rows = [(i, f"{line}\n" * (i < 30) + " ".join(f"p{i}x{k}" for k in range(25)), "large")
            for i in range(400)]  # the line is in 7.5 % of the texts
    rows.append((400, f"{line}\n" * 9 + "two words", "large"))
    rows += [(500 + i, f"{line}\n" + " ".join(f"q{i}x{k}" for k in range(25)), "small")
             for i in range(20)]  # at the limit
    path = str(tmp_path / "documents.parquet")
    spark.createDataFrame(rows, "doc_id long, text string, source string").write.parquet(path)
    found = QUERIES["op3_line_quality"](spark, str(tmp_path))
    names = sorted(found.columns)
    with duckdb.connect() as duck:
        duck.execute(f"create view documents as from read_parquet('{path}/*.parquet')")
        want = duck.sql(ORACLES["op3_line_quality"]).select(*names).fetchall()
    got = [tuple(row) for row in found.select(*names).collect()]
    assert sorted(got) == sorted(want)
    removed = {row.doc_id: row.n_removed_words for row in found.collect()}
    assert all(removed[i] == 8 * (i < 30) for i in range(400))
    assert removed[400] == 72 and not any(removed[500 + i] for i in range(20))
