"""Derived columns, bins, gaps, encodings, scaling."""

import math

import pytest
from pyspark.sql import functions as F

from cohortwise.functions import bins as B
from cohortwise.functions import numeric as N
from cohortwise.functions import text as X
from cohortwise.operators import encode as E
from cohortwise.operators import impute as I
from cohortwise.operators import scale as S


def values(spark, column, items, type_="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(items)], f"i int, v {type_}")
    return [r[0] for r in df.orderBy("i").select(column).collect()]


@pytest.fixture(autouse=True, scope="module")
def _columns(spark):
    global V
    V = F.col("v")


def test_titles(spark):
    names = ["A, Mr. B", "A, Mrs. B", "A, Miss. B", "A, Master. B", "A, Dr. B", "A, Col. B", "A, Mlle. B", "A, Mme. B", "A B", "A, Dona. B"]
    v1 = values(spark, X.token_mapped(V, X.TITLE_PATTERN, X.TITLES_RARE), names)
    assert v1 == ["Mr", "Mrs", "Miss", "Master", "Rare", "Rare", "Miss", "Mrs", "Unknown", "Dona"]
    v3 = values(spark, X.token_grouped(V, X.TITLE_PATTERN, X.TITLES_RARE_OR_OTHER), names + ["A, King. B"])
    assert v3[-2:] == ["Rare", "Other"] and v3[8] == "Unknown"
    v2 = X.token_or_fallback(V, X.TITLE_PATTERN, X.TITLES_OFFICER, X.TITLES_KEPT, F.lit("female"), X.TITLE_BY_SEX)
    assert values(spark, v2, names)[4:] == ["Officer", "Officer", "Miss", "Mrs", "Mrs", "Mrs"]


def test_text_parts(spark):
    cabins = ["C85", "A36", "B57 B59 B63 B66", None, ""]
    assert values(spark, X.first_char(V), cabins) == ["C", "A", "B", "Unknown", "Unknown"]
    assert values(spark, X.first_int(V), cabins) == [85, 36, 57, -1, -1]
    assert values(spark, X.token_count(V), cabins) == [1, 1, 4, 0, 1]
    tickets = ["A/5 21171", "PC 17599", "330911", "STON/O2. 3101282", "LINE", None]
    assert values(spark, X.letter_prefix(V), tickets) == ["A/", "PC", "None", "STON/O", "LINE", "None"]
    assert values(spark, X.prefix_without_digits(V), tickets) == ["A", "PC", "Numeric", "STONO", "LINE", "Unknown"]
    assert values(spark, X.trailing_int(V), tickets) == [21171, 17599, 330911, 3101282, 0, 0]
    assert values(spark, X.last_int(V), tickets + ["7 x 9 y"]) == [21171, 17599, 330911, 3101282, -1, -1, 9]
    names = ["Kelly, Mr. James", "del Carlo, Mrs. S", "O'Donoghue, Ms. B", "no comma"]
    assert values(spark, X.family_name(V), names) == ["Kelly", "Carlo", "Donoghue", None]
    assert values(spark, X.crossed(V, F.lit(3)), ["a", None]) == ["a_3", "Unknown_3"]


def test_numbers(spark):
    df = spark.createDataFrame([(1, 0, 30.0), (0, 1, 50.0), (2, 1, 20.0), (0, 0, None)], "a int, b int, fare double")
    size = N.group_size(F.col("a"), F.col("b"))
    rows = df.select(size.alias("s"), N.is_alone(size).alias("o"), N.ratio(F.col("fare"), size).alias("r")).collect()
    assert [tuple(r) for r in rows] == [(2, 0, 15.0), (2, 0, 25.0), (4, 0, 5.0), (1, 1, None)]
    assert values(spark, N.size_class(V), [1, 3, 4, 5, None], "int") == ["Alone", "Small", "Medium", "Large", None]
    assert values(spark, N.size_class(V, legacy=True), [1, 3, 4, 5], "int") == ["Small", "Small", "Small", "Large"]
    ages = [None, 4.9, 5.0, 12.0, 18.0, 25.0, 35.0, 50.0, 65.0]
    assert values(spark, N.age_category(V), ages, "double") == [
        "Unknown", "Baby", "Child", "Teen", "YoungAdult", "Adult", "MiddleAge", "Senior", "Elderly",
    ]
    assert values(spark, N.root(V), [4.0, -1.0], "double") == [2.0, None]
    assert values(spark, N.log1p(V), [0.0, -2.0], "double") == [0.0, None]


def test_bins(spark):
    points = [0.0, 1.0, 5.0, 10.0, 10.1, None, float("nan")]
    assert values(spark, B.cut(V, [0, 5, 10], ["a", "b"]), points, "double") == [None, "a", "a", "b", None, None, None]
    assert values(spark, B.cut(V, [0, 5, 10], ["a", "b"], include_lowest=True), points, "double")[0] == "a"
    assert values(spark, B.cut(V, [0, 5, 10], ["a", "b"], right=False), points, "double") == ["a", "a", "b", None, None, None, None]
    many = [float(i) for i in range(40)]
    assert values(spark, B.cut(V, many, list(range(39)), right=False), [0.0, 17.5, 38.9], "double") == [0, 17, 38]
    df = spark.createDataFrame([(float(x),) for x in (0, 2, 4, 5, 10)], "v double")
    got = [r[0] for r in df.select(B.equal_width(df, "v", ["lo", "hi"])).collect()]
    assert got == ["lo", "lo", "lo", "lo", "hi"]
    edges, labels = B.quantile_edges(spark.createDataFrame([(1.0,)] * 9 + [(2.0,)], "v double"), "v", [0, 0.25, 0.5, 0.75, 1], list("abcd"))
    assert edges == [1.0, 2.0] and labels == ["d"]
    assert len(B.equal_width_edges(3.0, 3.0, 5)) == 6
    with pytest.raises(ValueError):
        B.cut(V, [0, 1], ["a", "b"])


def test_group_medians(spark):
    df = spark.createDataFrame(
        [(1, "male", 30.0), (1, "male", 40.0), (1, "male", None), (2, "female", 20.0), (2, "female", 25.0), (2, "female", None), (3, "x", None)],
        "k int, s string, v double",
    )
    out = I.MedianImputer("v", [["k", "s"], []], staged=True).fit(df).transform(df)
    rows = [r["v"] for r in out.orderBy("k", "v").collect()]
    # The last row has an empty group: median of 30, 40, 35, 20, 25, 22.5.
    assert rows == [30.0, 35.0, 40.0, 20.0, 22.5, 25.0, 27.5]
    with pytest.raises(ValueError):
        I.MedianImputer("v", [["k"]]).transform(df)
    full = df.filter("v is not null")
    assert I.MedianImputer("v", [["k"]]).fit(df).transform(full).exceptAll(full).count() == 0


def test_gap_filling_leaves_nothing_empty(spark):
    ports = ["S", "C", None, "S", "Q", "S", "C", None]
    rows = [
        (i, k, s, None if i in (2, 4, 5) else 20.0 + i, None if i in (2, 5) else 10.0 * i + 1, ports[i])
        for i, (k, s) in enumerate(zip([1, 1, 2, 2, 3, 3, 1, 2], ["m", "f"] * 4))
    ]
    df = spark.createDataFrame(rows, "id int, k int, s string, age double, fare double, port string")
    filling = I.GapFilling("age", "fare", "port", "k", "s").fit(df)
    out = filling.transform(df)
    assert out.filter("age is null or fare is null or port is null").count() == 0
    assert {r["port"] for r in out.filter("id in (2, 7)").collect()} == {"S"}
    assert filling.transform(df.limit(0)).count() == 0


def test_mode_ties_and_default(spark):
    df = spark.createDataFrame([("S",), ("C",), (None,)], "p string")
    assert I.column_mode(df, "p") == "C"
    assert I.column_mode(df.filter("p is null"), "p", "S") == "S"


def test_nearest_median(spark):
    rows = [(1, "C", 80.0), (1, "S", 20.0), (1, None, 70.0), (1, None, 30.0), (2, "Q", 5.0), (2, None, None), (3, None, 9.0), (1, None, 50.0)]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "id int, k int, p string, v double")
    out = {r["id"]: r["p"] for r in I.NearestMedianImputer("p", "k", "v", ["C", "Q", "S"]).fit(df).transform(df).collect()}
    assert (out[2], out[3], out[5], out[6], out[7]) == ("C", "S", "Q", "C", "C")


def test_constant_and_simple_fills(spark):
    df = spark.createDataFrame([("Mr", None), ("Miss", 5.0), ("Dr", None)], "t string, age double")
    ages = [r["age"] for r in I.fill_from_map(df, "age", "t", I.AGE_BY_TITLE).collect()]
    assert ages == [32.32, 5.0, None]
    simple = I.SimpleImputer(median=["age"], constant={"t": "S"}).fit(df)
    assert [r["age"] for r in simple.transform(df).collect()] == [5.0, 5.0, 5.0]


def test_onehot_is_aligned(spark):
    train = spark.createDataFrame([("a",), ("b",), (None,)], "c string")
    score = spark.createDataFrame([("b",), ("z",), (None,)], "c string")
    enc = E.OneHot(["c"]).fit(train)
    assert enc.names == ["c_a", "c_b"]
    assert [tuple(r)[1:] for r in enc.transform(score).collect()] == [(0, 1), (0, 0), (0, 0)]
    assert E.OneHot(["c"], drop_first=True).fit(train).names == ["c_b"]
    rare = E.OneHot(["c"], min_share=0.6).fit(train)
    assert rare.names == ["c_Rare"] and [r["c_Rare"] for r in rare.transform(train).collect()] == [1, 1, 0]


@pytest.mark.parametrize("bound", [100, 0])
def test_label_codes_small_and_large_vocabulary(spark, bound, monkeypatch):
    monkeypatch.setattr(E, "ONE_TASK_VALUES", bound)
    df = spark.createDataFrame([(f"v{i % 40:02d}",) for i in range(200)], "c string")
    got = {r["c"]: r["c_encoded"] for r in E.LabelCodes(["c"]).fit(df).transform(df).distinct().collect()}
    assert got == {f"v{i:02d}": i for i in range(40)}


def test_label_codes_rare_and_alignment(spark):
    train = spark.createDataFrame([("b",), ("a",), ("b",), ("d",)], "c string")
    score = spark.createDataFrame([("a",), ("c",), ("d",)], "c string")
    codes = E.LabelCodes(["c"]).fit(train)
    assert {r["c"]: r["c_encoded"] for r in codes.transform(score).collect()} == {"a": 0, "c": -1, "d": 2}
    rare = E.RareGroups(["c"], threshold=2).fit(train)
    assert sorted(r["c"] for r in rare.transform(train).collect()) == ["Rare", "Rare", "b", "b"]
    assert E.align_columns(score, ["x", "c"]).columns == ["x", "c"]


def test_standardizer_uses_population_deviation(spark):
    df = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0)], "a double, b double")
    rows = S.Standardizer().fit(df).transform(df).orderBy("a").collect()
    assert [tuple(r) for r in rows] == [(-1.0, 0.0), (1.0, 0.0)]
    wide = df.select(*[(F.col("a") * i).alias(f"c{i}") for i in range(1, 31)])
    scaled = S.Standardizer().fit(wide).transform(wide).collect()
    assert all(abs(abs(v) - 1.0) < 1e-12 for r in scaled for v in r)


def test_feature_scores(spark):
    df = spark.createDataFrame([(float(i % 2), float(i % 3), i % 2) for i in range(60)], "good double, bad double, y int")
    f = {r["feature"]: r["f_value"] for r in S.anova_f(df, ["good", "bad"], "y").collect()}
    assert f["good"] is None or f["good"] > 1e6
    mi = {r["feature"]: r["mutual_info"] for r in S.mutual_information(df, ["good", "bad"], "y").collect()}
    assert mi["good"] == pytest.approx(math.log(2)) and mi["bad"] == pytest.approx(0.0, abs=1e-9)
    selector = S.FeatureSelector(k=1, forced=["bad"]).fit(df, ["good", "bad"], "y")
    assert selector.selected == ["good", "bad"]
