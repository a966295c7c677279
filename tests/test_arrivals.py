"""Month loads from files that arrive late, twice, or in a batch that fails."""

import pytest
from conftest import day, rows

from martloom import schemas
from martloom.sources.tables import declared_folders, read_partitioned
from martloom.streaming import arrivals

SCHEMA = schemas.table("k long!, d date, n int")
ROWS = "k long, d date, n int"


@pytest.fixture
def place(spark, tmp_path):
    """Puts a file in the landing folder, and loads what has arrived."""

    class Place:
        path, number = str(tmp_path / "table"), 0

        def arrive(self, *given):
            self.number += 1
            df = spark.createDataFrame(list(given), ROWS).coalesce(1)
            df.write.parquet(str(tmp_path / "landing" / str(self.number)))

        def load(self):
            return arrivals.load_arrivals(
                spark, str(tmp_path / "landing" / "*"), self.path, SCHEMA, "d", ["k"],
                str(tmp_path / "arrived"), str(tmp_path / "checkpoint"), 1,
            )

        def table(self):
            return rows(read_partitioned(spark, self.path, SCHEMA))

    return Place()


JAN, FEB, MAY = day("2021-01-10"), day("2021-02-10"), day("2021-05-10")


def test_late_and_repeated_files(spark, place):
    place.arrive((1, JAN, 1), (2, FEB, 2), (3, MAY, 3), (4, None, 4))
    assert [r.months for r in place.load()] == [{"202101": 1, "202102": 1}, {"202105": 1}]
    place.arrive((2, FEB, 20), (5, FEB, 5))
    place.arrive((1, JAN, 1))  # again, as it was
    loads = place.load()
    assert [r.months for r in loads] == [{"202102": 2}, {}] and loads[1].unchanged == ("202101",)
    assert place.table() == sorted([(1, JAN, 1), (2, FEB, 20), (5, FEB, 5), (3, MAY, 3)], key=repr)
    assert declared_folders(spark, place.path) == ["202101", "202102", "202105"]
    assert place.load() == []  # nothing new


def test_a_failed_batch_is_taken_again(spark, place, monkeypatch):
    place.arrive((1, JAN, 1))
    place.load()
    place.arrive((2, JAN, 2), (1, JAN, 10))

    def dies(*_, **__):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(arrivals, "load_months", dies)
        with pytest.raises(Exception, match="lost"):
            place.load()
    assert place.table() == [(1, JAN, 1)]
    assert [r.months for r in place.load()] == [{"202101": 2}]
    assert place.table() == [(1, JAN, 10), (2, JAN, 2)]
