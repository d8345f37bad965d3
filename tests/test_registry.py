from refsync.sources.registry import RESOURCES, resource

# Number of exported columns, in export order.
COLUMNS = [4, 8, 8, 5, 14, 5, 8, 9, 7, 5, 5, 11, 11, 35, 9, 12, 8, 12, 5, 5, 10]


def test_all_resources_in_order():
    assert [len(spec.columns) for spec in RESOURCES] == COLUMNS
    names = [spec.name for spec in RESOURCES]
    assert names.index("referencedata.geographic_levels") == 0
    assert names.index("referencedata.program_orderables") < names.index(
        "referencedata.price_changes"
    )
    assert names.index("stockmanagement.stock_events") < names.index(
        "stockmanagement.stock_cards"
    )
    assert len({spec.target for spec in RESOURCES}) == 21


def test_named_sources():
    lines = dict(resource("requisition.requisition_line_items").columns)
    assert lines["max_stock_quantity"] == "maximumstockquantity"
    assert lines["product_id"] == "orderableid"
    assert lines["calculated_order_quantity_isa"] == "calculatedorderquantityisa"
    programs = dict(resource("referencedata.programs").columns)
    assert programs["period_sskippable"] == "periodsskippable"
    assert dict(resource("referencedata.lots").columns)["code"] == "lotcode"
    assert dict(resource("referencedata.orderables").columns)["name"] == "fullproductname"


def test_text_columns_and_keys_exist():
    for spec in RESOURCES:
        assert set(spec.text) <= set(spec.sources), spec.name
        assert set(spec.key) <= set(spec.sources), spec.name
