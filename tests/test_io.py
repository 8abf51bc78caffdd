import json

import pytest

from custvalue.operators import explore, serve
from custvalue.sources import readers, schemas, sinks


def test_transactions_csv(spark, tmp_path):
    path = tmp_path / "dump.csv"
    path.write_text(
        "InvoiceNo,StockCode,Description,Quantity,InvoiceDate,UnitPrice,CustomerID,Country\n"
        '536365,85123A,"HEART, ""WHITE""",6,12/01/10 08:26,2.55,0017850,United Kingdom\n'
        "536366,22633,,-1,12/01/10 08:28,1.85,,\n"
    )
    rows = readers.read_transactions(spark, str(path)).collect()
    assert rows[0].Description == 'HEART, "WHITE"' and rows[0].CustomerID == "0017850"
    assert rows[1].Quantity == -1 and rows[1].CustomerID is None and rows[1].Description is None
    kinds = {"bigint": 1, "double": 1, "string": 6}
    types = list(readers.column_specs(readers.read_transactions(spark, str(path))).values())
    assert {t: types.count(t) for t in set(types)} == kinds


def test_malformed_csv_stops(spark, tmp_path):
    path = tmp_path / "bad.csv"
    path.write_text("a,many,not a number,1,1,1,1,1,1,1\n")
    with pytest.raises(Exception, match="MALFORMED"):
        readers.read_scoring(spark, str(path)).collect()


SAMPLE = "0123456789,1000.0,10,2,240,4.0,240.0,13.0,1,1\n1234567890,500.0,20,3,250,5.0,250.0,15.0,,\n"


def test_scoring_forms(spark, tmp_path):
    plain, headed, lines = (tmp_path / n for n in ("a.csv", "b.csv", "c.json"))
    names = schemas.SCORING.fieldNames()
    plain.write_text(SAMPLE)
    headed.write_text(",".join(names) + "\n" + SAMPLE)
    rows = readers.read_scoring(spark, str(plain)).orderBy("customer_id").collect()
    assert rows[0].customer_id == "0123456789"
    assert (rows[1].cnt_returns, rows[1].has_returned) == (0, -1)
    lines.write_text("\n".join(json.dumps(r.asDict()) for r in rows))
    for other in (
        readers.read_scoring(spark, str(headed), header=True),
        readers.read_scoring(spark, str(lines), fmt="json"),
    ):
        assert other.orderBy("customer_id").collect() == rows
    with pytest.raises(ValueError):
        readers.read_scoring(spark, str(plain), fmt="xml")


def test_other_header_is_refused(spark, tmp_path):
    path = tmp_path / "old.csv"
    path.write_text(
        "customer_id,monetary,recency,frequency,avg_basket_value,avg_basket_size,date_range,"
        "cnt_orders,cnt_returns,has_returned\n" + SAMPLE
    )
    with pytest.raises(Exception, match="(?i)header"):
        readers.read_scoring(spark, str(path), header=True).collect()


def test_header_of_transactions_may_be_passed_over(spark, tmp_path):
    path = tmp_path / "lines.csv"
    path.write_text("a,b,c,d,e,f,g,h\n1,2,text,3,01/02/10 10:00,1.5,7,Spain\n")
    with pytest.raises(Exception, match="(?i)header"):
        readers.read_transactions(spark, str(path)).collect()
    row = readers.read_transactions(spark, str(path), check_header=False).first()
    assert (row.InvoiceNo, row.Quantity, row.Country) == ("1", 3, "Spain")


def test_used_columns_and_defaults():
    assert len(schemas.FEATURES) == 16 and len(schemas.SCORING) == 10
    used = schemas.used_columns(with_key=True, with_target=True)
    assert used[0] == "customer_id" and used[-1] == "target_monetary" and len(used) == 11
    got = [schemas.DEFAULTS[name] for name in ("has_returned", "T", "time_between")]
    assert got == [-1, 0, 0.0]


def test_tables_by_name(spark, feature_rows):
    feature_rows.createOrReplaceTempView("some_features")
    assert readers.read_table(spark, "some_features").count() == feature_rows.count()
    top = readers.query(spark, "SELECT * FROM some_features WHERE recency > :days", days=1500)
    assert 0 < top.count() < feature_rows.count()


def test_split_reader_checks_name(spark):
    with pytest.raises(ValueError):
        readers.read_split(spark, "/tmp", "all")


LINES = [
    '{"customer_id": "abc", "predicted_monetary": 427.76}',
    '{"customer_id": 12, "predicted_monetary": 1, "other": [1]}',
    '{"predicted_monetary": 5.5}',
    '{"customer_id": "x"}',
    '{"customer_id": "abc", "predicted_mon',
    '{"customer_id": "abc", "predicted_monetary": "much"}',
    "not json",
    "null",
    "[1, 2]",
    "",
]


def test_entities_and_errors(spark):
    lines = spark.createDataFrame([(x,) for x in LINES], "value string")
    got = {r.line: r.entity for r in serve.entities(lines).collect()}
    assert json.loads(got[LINES[0]]) == {
        "key": {"path": [{"kind": "clv", "name": "abc"}]},
        "properties": {"predicted_monetary": {"doubleValue": 427.76}},
    }
    assert json.loads(got[LINES[1]])["key"]["path"] == [{"kind": "clv", "name": "12"}]
    assert json.loads(got[LINES[2]])["key"]["path"] == [{"kind": "clv"}]
    assert json.loads(got[LINES[3]])["properties"] == {"predicted_monetary": {}}
    assert [r.line for r in serve.entity_errors(lines).collect()] == LINES[4:]
    assert serve.good_entities(lines).count() == 4


def test_rows_reach_a_writer(spark, tmp_path):
    folder = str(tmp_path)

    def writer(rows):
        for row in rows:
            with open(f"{folder}/{row.id}", "w"):
                pass

    sinks.send_rows(spark.range(5), writer)
    assert len(list(tmp_path.iterdir())) == 5


def test_sample_never_takes_rows_without_customer(spark):
    rows = [("1", "s", "d", 1, "12/01/10 08:26", 1.0 * i, None, "x") for i in range(300)]
    source = spark.createDataFrame(rows, schemas.TRANSACTIONS)
    assert explore.sample(source).count() == 0
    known = source.fillna({"CustomerID": "7"})
    assert 0 < explore.sample(known).count() < 30
    with pytest.raises(ValueError):
        explore.sample(known, one_in=1)


def test_stream_of_lines(spark, tmp_path):
    """The row-wise entity transform also runs on a stream."""
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "part").write_text("\n".join(LINES[:6]))
    stream = serve.entities(spark.readStream.text(str(tmp_path / "in")))
    job = stream.writeStream.format("memory").queryName("entity_stream").trigger(availableNow=True).start()
    job.awaitTermination(60)
    assert spark.table("entity_stream").where("entity IS NOT NULL").count() == 4
