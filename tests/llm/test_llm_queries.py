"""Every query of the problems runs on the smallest tables with the columns that are asked for."""

import pytest

from edicta.llm import queries

COLUMNS = {
    "p1_found": ["record_id"], "p2_found": ["id", "line_no", "kind"], "p3_found": ["row_key", "area_id"], "p4_found": ["record_id", "dup_record_id"], "p5_found": ["id", "record_id"],
    "p6_found": ["record_id", "field"], "p7_found": ["row_key", "comuna_nombre"], "p8_ids": ["doc_id", "ids"], "p10_found": ["doc_id"],
}


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_runs(spark, sf_dir, name):
    df = queries.QUERIES[name](spark, sf_dir)
    rows = df.collect()
    if name in COLUMNS:
        assert df.columns == COLUMNS[name]
        assert len(rows) == len({str(r) for r in rows}) > 0


def test_areas_leave_out_residue(spark, sf_dir):
    bad = {r.record_id for r in queries.p1_found(spark, sf_dir).collect()}
    assert not bad & {r.row_key for r in queries.p3_found(spark, sf_dir).collect()}
