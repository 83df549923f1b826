"""What the JDBC source sends, without a database: no driver or server is at hand."""

import pytest

from tablescout.sources.base import Watermark
from tablescout.sources.jdbc import JdbcSource, Split


class Recorded(JdbcSource):
    """Answers metadata queries from given rows and records their SQL."""

    def __init__(self, spark, answers, **kwargs):
        super().__init__(spark, {"url": "jdbc:none"}, "SYS", "db", "dbo", **kwargs)
        self.answers, self.sent = answers, []

    def query(self, sql):
        self.sent.append(sql)
        data, schema = next(answer for part, answer in self.answers.items() if part in sql)
        return self.spark.createDataFrame(data, schema)


def test_metadata_queries(spark):
    answers = {
        "information_schema.tables": ([("Zeta",), ("alpha",)], "table_name string"),
        "information_schema.columns": (
            [("b", 2, "varchar", 10, None, None, "YES"), ("a", 1, "numeric", None, 12, 2, "NO")],
            "source_column string, source_ordinal_position int, source_data_type string, "
            "source_character_maximum_length int, source_numeric_precision int, source_numeric_scale int, "
            "source_is_nullable string",
        ),
        "COUNT(*)": ([(7,)], "n int"),
        "MAX([up]]d])": ([(5,)], "max_watermark int"),
    }
    source = Recorded(spark, answers, dialect="sqlserver")
    assert source.table_names() == ["Zeta", "alpha"]
    columns = source.columns("it's")
    assert [tuple(r)[:4] for r in columns.collect()] == [("it's", "a", 1, "numeric"), ("it's", "b", 2, "varchar")]
    assert "table_name = 'it''s'" in source.sent[1]
    assert source.row_count("t") == 7 and source.sent[-1].endswith("FROM [dbo].[t]")
    assert source.max_watermark("t", "up]d").head().MAX_WATERMARK == 5


def points(spark, values, dialect="redshift", schema="point int"):
    return Recorded(spark, {"NTILE": ([(v,) for v in values], schema)}, dialect=dialect)


def test_split_points_are_those_of_the_rows_to_be_read(spark):
    source = points(spark, [30, 10, 20, 20, 45])
    assert source._predicates("t", Split("id", 5)) == [
        '"id" <= 10 OR "id" IS NULL', '"id" > 10 AND "id" <= 20', '"id" > 20 AND "id" <= 30', '"id" > 30',
    ]
    assert source.sent == [
        'SELECT MAX(V) AS POINT FROM (SELECT V, NTILE(5) OVER (ORDER BY V) AS SHARE FROM (SELECT "id" AS V FROM "dbo"."t") AS SPLIT_ROWS '
        "WHERE V IS NOT NULL) AS SPLIT_SHARES GROUP BY SHARE"
    ]
    source._predicates("t", Split("id", 5, sample=0.01), "\"at\" > '2024-01-01'")
    assert "FROM \"dbo\".\"t\" WHERE \"at\" > '2024-01-01' AND RANDOM() < 0.01) AS" in source.sent[-1]
    server = points(spark, ["it's", "b"], "sqlserver", "point string")
    assert server._predicates("t", Split("na]me", 2, sample=0.5)) == ["[na]]me] <= 'b' OR [na]]me] IS NULL", "[na]]me] > 'b'"]
    assert "% 1000000) < 500000" in server.sent[-1]
    assert points(spark, [])._predicates("t", Split("id", 4)) == points(spark, [7])._predicates("t", Split("id", 4)) == ["1 = 1"]


def test_every_row_meets_one_range(spark):
    """The conditions part a table, also rows without a value and values that are repeated."""
    values = [None, 1, 1, 1, 1, 2, 5, 9, 9, 12, None]
    frame = spark.createDataFrame([(v,) for v in values], "id int")
    source = points(spark, [1, 1, 5, 12])
    counts = [frame.where(p.replace('"', "`")).count() for p in source._predicates("t", Split("id", 4))]
    assert counts == [6, 2, 3] and sum(counts) == len(values)


def test_an_increment_is_parted_by_its_own_rows(spark, monkeypatch):
    source = points(spark, [15, 30])
    source.splits = {"t": Split("id", 2)}
    asked = []

    def jdbc(self, url, table, predicates, properties):
        asked.append((url, table, predicates, properties))
        return spark.createDataFrame([(1, 5), (2, 9)], "id int, at int")

    monkeypatch.setattr(type(spark.read), "jdbc", jdbc)
    assert source.read_since("t", "at", Watermark("7", "int")).collect() == [(2, 9)]
    assert source.sent[-1].count('FROM "dbo"."t" WHERE "at" > 7)') == 1
    assert asked == [("jdbc:none", '"dbo"."t"', ['"id" <= 15 OR "id" IS NULL', '"id" > 15'], {"fetchsize": "50000"})]
    source.read("t")
    assert " WHERE " not in source.sent[-1].split("AS SPLIT_ROWS")[0]


def test_counts_without_watermark(spark):
    source = Recorded(spark, {"COUNT(*)": ([(3,)], "n int")}, dialect="redshift")
    assert source.count_since("t", "ts", None) == 3
    with pytest.raises(Exception, match="(?i)driver|jdbc"):
        source.count_since("t", "ts", Watermark("1", "int"))
