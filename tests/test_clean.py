import pytest

from tillgrain.errors import DataContractError
from tillgrain.operators import clean as cl, quality
from tillgrain.schema import REQUIRED


def frame(spark, rows):
    columns = ["Invoice", "StockCode", "Description", "Quantity", "InvoiceDate", "Price", "Customer ID", "Country"]
    return spark.createDataFrame(rows, ", ".join(f"`{c}` string" for c in columns))


def line(invoice="1", stock="A", text="MUG", qty="2", date="2021-01-15 10:00:00", price="10", customer="c1",
         country="UK"):
    return (invoice, stock, text, qty, date, price, customer, country)


def test_coercion_and_guests(spark):
    rows = frame(spark, [line(qty="x"), line(price="NaN"), line(date="??"), line(customer=None),
                         line(customer="17850.0"), line(customer="nan"), line(date="1/2/2021 9:05")])
    got = cl.bucket_guests(cl.coerce_types(rows)).collect()
    assert got[0]["Quantity"] is None and got[1]["Price"] is None and got[2]["InvoiceDate"] is None
    assert [r["Customer ID"] for r in got[3:6]] == ["GUEST", "17850", "GUEST"]
    assert str(got[6]["InvoiceDate"]) == "2021-01-02 09:05:00"
    assert cl.drop_missing_critical(cl.coerce_types(rows)).count() == 4


def test_description_mode_tie_and_unknown(spark):
    rows = frame(spark, [line(text="b"), line(text="a"), line(text=None), line(stock="Z", text=None)])
    filled = {(r["StockCode"], r["Description"]) for r in cl.fill_descriptions(rows).collect()}
    assert filled == {("A", "a"), ("A", "b"), ("Z", "Unknown")}
    assert cl.fill_descriptions(rows).count() == 4


def test_texts_are_counted_for_products_with_gaps_alone(spark, monkeypatch):
    rows = frame(spark, [line(text="a"), line(text=None), *[line(stock=f"B{i}") for i in range(20)]])
    counted, modes = [], cl.description_modes
    monkeypatch.setattr(cl, "description_modes", lambda df: counted.append(df.count()) or modes(df))
    few = sorted(map(tuple, cl.fill_descriptions(rows).collect()))
    monkeypatch.setattr(cl, "broadcast_rows", lambda lookup: 0)
    assert few == sorted(map(tuple, cl.fill_descriptions(rows).collect())) and len(few) == 22
    assert counted == [2, 22]


def test_country_mode(spark):
    rows = frame(spark, [line(country="UK"), line(country="DE"), line(country="DE"), line(country=None)])
    assert sorted(r["Country"] for r in cl.fill_countries(rows).collect()) == ["DE", "DE", "DE", "UK"]
    nothing = frame(spark, [line(country=None)])
    assert cl.fill_countries(nothing).first()["Country"] is None


def test_lines_that_differ_above_the_cap_collapse(spark):
    rows = frame(spark, [line(invoice=str(i), price=str(i)) for i in range(1, 200)]
                 + [line(invoice="x", price="5000"), line(invoice="x", price="9000")])
    cleaned = cl.clean_transactions(rows, caps=cl.Caps(300.0, 2.0))
    capped = cleaned.filter("Invoice = 'x'").collect()
    assert len(capped) == 1 and capped[0]["Price"] == 300.0 and capped[0]["is_outlier_capped"] == 1
    assert cleaned.count() == 200


def test_negative_quantity_is_removed(spark):
    cleaned = cl.clean_transactions(frame(spark, [line(qty="-1"), line(invoice="2", qty="5")]))
    assert [r["Quantity"] for r in cleaned.collect()] == [5.0]


def test_gates(spark):
    with pytest.raises(DataContractError, match="empty"):
        quality.assert_raw(frame(spark, []))
    with pytest.raises(DataContractError, match="InvoiceDate"):
        quality.assert_raw(cl.coerce_types(frame(spark, [line(date="?")])))
    with pytest.raises(DataContractError, match="Description"):
        quality.assert_raw(frame(spark, [line(text=None)]))
    with pytest.raises(DataContractError, match="missing"):
        quality.assert_features(frame(spark, [line()]))
    assert quality.profile(frame(spark, [line()])).count() == len(REQUIRED)
