"""Search pages as Variants."""

import json

from letwise.operators.flatten import item_to_row, variant_to_row
from letwise.sources.files import CORRUPT, read_pages, variant_items


def land(tmp_path, *pages):
    (tmp_path / "pages").mkdir(exist_ok=True)
    (tmp_path / "pages" / "p.json").write_text("\n".join(p if isinstance(p, str) else json.dumps(p) for p in pages))
    return str(tmp_path / "pages")


def item(**attributes):
    return {"id": 1, "attributes": attributes}


def test_variants_equal_the_text_route(spark, tmp_path):
    path = land(tmp_path, {"data": [item(list_id="1", price_label="RM 5", property_type_name=["Flat", "B"], region_name="Johor", subarea_name="X", size=719,
                                         size_suffix="sq.ft.", store_verified=["a", None, "b"], published_date="", date="2026-05-01", rooms_name=3, name=None,
                                         unknown={"x": 1}),
                                    item(list_id=2, building_name=" B ", property_type_id=7, category_name="Room", published_date=["p", "q"]), {"id": 3}],
                           "meta": {"total-results": 12}}, {"data": []})
    items, bad = variant_items(spark, path)
    assert bad.count() == 0
    got = variant_to_row(items)
    want = item_to_row(read_pages(spark, path))
    assert got.columns == want.columns and sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    assert {r.page_total for r in got.collect()} == {12}


def test_a_scalar_that_looks_like_a_list_stays(spark, tmp_path):
    items, _ = variant_items(spark, land(tmp_path, {"data": [item(list_id="1", name='["x"]', region_name=["KL", "[y]"])]}))
    row = variant_to_row(items).first()
    assert row.seller_name == '["x"]' and row.state == "KL, [y]"


def test_pages_that_are_not_good(spark, tmp_path):
    items, bad = variant_items(spark, land(tmp_path, '{"data": [', {"meta": {}}, {"data": "none"}, "   ", {"data": [item(list_id="9")]}))
    assert [r.ads_id for r in variant_to_row(items).collect()] == ["9"]
    assert sorted(r[CORRUPT] for r in bad.collect()) == ['{"data": "none"}', '{"data": [', '{"meta": {}}']
