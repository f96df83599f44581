import datetime as dt

from wiremap.operators.asof import asof_latest

T = dt.datetime(2024, 1, 1, 0, 0, 0)


def s(x):
    return T + dt.timedelta(seconds=x)


def test_strictly_before_across_buckets(spark):
    left = spark.createDataFrame([(1, "k", s(10)), (2, "k", s(130)), (3, "k", s(5)),
                                  (4, "k", s(200)), (5, "j", s(200)), (6, None, s(200)),
                                  (7, "k", None)],
                                 "id int, key string, t timestamp")
    right = spark.createDataFrame([("k", s(5), "a"), ("k", s(61), "b"), ("k", s(200), "c"),
                                   ("k", s(61), "a"), (None, s(1), "n")],
                                  "key string, rt timestamp, v string")
    for width in (1, 60, 3600):
        out = {r.id: (r.asof.v if r.asof else None) for r in
               asof_latest(left, right, ["key"], "t", "rt", ["v"], bucket_seconds=width).collect()}
        # id 1: start at 5 s; id 2 and 4: the 61 s tie resolves to the smallest value;
        # id 3: equal time is not before; others: no key / no time / no rows
        assert out == {1: "a", 2: "a", 3: None, 4: "a", 5: None, 6: None, 7: None}, width
