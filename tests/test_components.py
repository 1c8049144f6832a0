"""Components and suggestions against published values."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.ml.linalg import DenseVector, Vectors, VectorUDT
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from delaykit.operators import pca, suggestions
from delaykit.operators.engineered import engineer_all, suggestions_by_type
from delaykit.operators.lookups import settled

# A published sample of 53 requests (hour, weekday, airport,
# carrier), the mean delays it uses, and the results for it.
SAMPLE = """
1 5 LAX UA, 23 4 IAD DL, 17 6 DEN G4, 2 1 DEN OO, 6 1 ATL F9, 8 6 ATL MQ,
20 3 DEN UA, 19 2 LAX MQ, 20 2 IAD G7, 16 1 DEN AS, 12 2 IAD OO, 0 4 LAX NK,
9 0 IAD 9E, 3 3 DEN MQ, 17 2 LAX AS, 1 6 LAX HA, 5 0 LAX B6, 2 6 ATL YV,
19 1 DEN F9, 23 1 IAD AS, 20 0 LAX G4, 16 6 LAX QX, 3 6 ATL OH, 6 6 ATL UA,
5 3 LAX AA, 20 3 DEN B6, 21 1 ATL 9E, 0 3 ATL OO, 10 6 IAD YV, 17 6 LAX F9,
7 2 ATL AA, 9 1 ATL AS, 18 2 ATL DL, 7 5 IAD AA, 5 1 IAD F9, 15 2 ATL YX,
14 1 DEN WN, 9 1 IAD YX, 19 2 DEN DL, 21 1 ATL B6, 15 3 LAX WN, 9 2 IAD G4,
13 0 IAD OH, 22 3 IAD WN, 6 3 IAD UA, 8 5 ATL ZW, 16 3 ATL WN, 22 2 ATL NK,
13 3 LAX DL, 4 6 LAX OO, 3 1 DEN AA, 18 4 DEN C5, 4 3 IAD C5,
"""
AIRPORTS = {"ATL": 71.23338068182191, "DEN": 67.73333796479112, "IAD": 75.85401709565633, "LAX": 63.36591399245681}
CARRIERS = {
    "9E": 77.87128945542746, "AA": 68.89984167302624, "AS": 46.20826002377768, "B6": 65.92580857893768,
    "C5": 106.56482661682668, "DL": 69.54662181914115, "F9": 75.14299432979108, "G4": 83.16536910530355,
    "G7": 95.59210456101108, "HA": 49.28821009357, "MQ": 50.1166469753157, "NK": 63.08045649141668,
    "OH": 71.99398781870963, "OO": 94.68690143913724, "QX": 59.58974042473394, "UA": 68.12120409697,
    "WN": 54.0662053062132, "YV": 78.65314650326226, "YX": 61.12261998251135, "ZW": 426.0,
}
FEATURES = [
    "dep_hour", "dow", "month", "is_weekend", "DISTANCE",
    "route_avg_delay", "origin_avg_delay", "airline_avg_delay",
]
RATIOS = [0.4277, 0.2210, 0.1682, 0.1554, 0.0277]
PC1 = {
    "dow": 0.6189094863420025, "is_weekend": 0.6359194294183299, "airline_avg_delay": 0.24463272572313322,
    "origin_avg_delay": -0.17071739751984114, "dep_hour": -0.35152229899889337,
}
IMPORTANCE = {
    "dow": 1.908864739741007, "airline_avg_delay": 1.8517319322232728, "is_weekend": 1.7558133176437956,
    "origin_avg_delay": 1.647640376268948, "dep_hour": 1.4918602418477716,
}
INTERACTIONS = [
    "dow_X_is_weekend", "dow_X_airline_avg_delay", "is_weekend_X_airline_avg_delay", "dow_DIV_dep_hour",
    "is_weekend_DIV_dep_hour", "airline_avg_delay_DIV_dep_hour", "origin_avg_delay_X_airline_avg_delay",
    "dep_hour_X_dow", "dep_hour_X_airline_avg_delay", "dow_X_airline_avg_delay",
]
CORRELATION = {("origin_avg_delay", "airline_avg_delay"): 0.08412764269576425, ("dow", "is_weekend"): 0.06315376234654776}


@pytest.fixture(scope="module")
def table(spark):
    rows = []
    for entry in SAMPLE.replace("\n", " ").split(","):
        if entry.strip():
            hour, dow, airport, carrier = entry.split()
            rows.append(
                (int(hour), int(dow), 7, int(int(dow) > 4), 500.0, 10.0, AIRPORTS[airport], CARRIERS[carrier])
            )
    kinds = ["int"] * 4 + ["double"] * 4
    return spark.createDataFrame(rows, ", ".join(f"{f} {k}" for f, k in zip(FEATURES, kinds)))


@pytest.fixture(scope="module")
def fitted(table):
    return pca.pca_fit(table, FEATURES)


def test_ratios_and_loadings(fitted):
    ratios = [r["ratio"] for r in fitted.variance.orderBy("pc").collect()]
    assert ratios[:5] == pytest.approx(RATIOS, abs=5e-5)
    first = {r["feature"]: r["loading"] for r in fitted.loadings.filter("pc = 1").collect()}
    for feature, value in PC1.items():
        assert first[feature] == pytest.approx(value, abs=1e-9)
    assert first["month"] == pytest.approx(0.0, abs=1e-12)


def test_importance_and_correlation(fitted):
    rows = pca.feature_importance_matrix(fitted.loadings).collect()
    assert [r["feature"] for r in rows[:5]] == list(IMPORTANCE)
    for r in rows[:5]:
        assert r["overall_importance"] == pytest.approx(IMPORTANCE[r["feature"]], abs=1e-9)
    corr = {(r["x"], r["y"]): r["corr"] for r in pca.loading_correlation(fitted.loadings).collect()}
    for pair, value in CORRELATION.items():
        assert corr[pair] == pytest.approx(value, abs=1e-8)
    assert corr["month", "dow"] is None and corr["DISTANCE", "DISTANCE"] is None


def test_components_needed(fitted):
    assert tuple(pca.components_needed(fitted.variance).first()) == (4, 4, 5)


def test_scores_have_the_component_variances(fitted, table):
    scores = pca.pca_scores(table, fitted)
    spread = scores.agg(*[F.var_pop(f"PC{i}") for i in range(1, 6)]).first()
    # Five columns vary, each with variance one.
    assert list(spread) == pytest.approx([5 * r for r in RATIOS], abs=5e-4)


def test_suggestions(fitted, table):
    report = suggestions.suggestion_report(fitted.loadings, fitted.variance).persist()
    counts = {r["type"]: r["n"] for r in suggestions.suggestion_counts(report).collect()}
    assert counts == {"interaction": 10, "polynomial": 16, "domain_composite": 2, "pca_derived": 5}
    by_type = suggestions_by_type(report)
    assert [s["new_feature_name"] for s in by_type["interaction"]] == INTERACTIONS
    assert [s["priority"] for s in by_type["interaction"]] == ["high"] * 3 + ["medium"] * 7
    assert [s["new_feature_name"] for s in by_type["polynomial"] if s["priority"] == "high"] == ["dow_squared"]
    assert [s["new_feature_name"] for s in by_type["domain_composite"]] == [
        "composite_delay_risk_score", "temporal_risk_category",
    ]
    assert [s["priority"] for s in by_type["pca_derived"]] == ["high"] * 4 + ["medium"]
    built = engineer_all(table, by_type)
    new = [c for c in built.columns if c not in FEATURES]
    assert new == INTERACTIONS[:3] + ["dow_squared", "composite_delay_risk_score", "temporal_risk_category"]


def test_greedy_groups(spark):
    names = ["a", "b", "c", "d"]
    rows = [(n, i, pc, v) for i, n in enumerate(names) for pc, v in enumerate([0.1 * i + 1, 2.0, 3.0, 4.0, 5.0], 1)]
    loadings = spark.createDataFrame(rows, "feature string, position int, pc int, loading double")
    got = suggestions.suggest_aggregations(loadings).orderBy("position").collect()
    assert [(r["operation"], r["features"], r["priority"]) for r in got] == [
        ("mean", names, "medium"), ("sum", names, "low"),
    ]
    assert got[0]["new_feature_name"] == "avg_a_b_group"


def dense(rows, width):
    out = np.zeros((len(rows), width))
    for i, row in enumerate(rows):
        out[i, : len(row) if isinstance(row, DenseVector) else width] = row.toArray()
    return out


def exact_ratios(matrix, k):
    centred = matrix - matrix.mean(axis=0)
    # The rows' products have the variances of the columns'.
    values = np.linalg.eigvalsh(centred @ centred.T)[::-1]
    return values[:k] / (centred**2).sum()


def sparse_rows(n, width, seed):
    random_ = np.random.default_rng(seed)
    rows = []
    for _ in range(n):
        at = np.unique(random_.zipf(1.3, size=6) % (width - 2)) + 2
        rows.append(Vectors.sparse(width, [0, 1, *at], [*random_.normal(3, (2, 1)), *np.ones(len(at))]))
    return rows


@pytest.mark.parametrize(("n", "width"), [(400, 40), (300, 70_000)])
def test_report_of_a_wide_matrix(spark, n, width):
    rows = sparse_rows(n, width, 4)
    if width < 100:
        rows[::3] = [DenseVector(r.toArray()) for r in rows[::3]]
    df = spark.createDataFrame([(r, 1) for r in rows] + [(None, 2)], StructType().add("features", VectorUDT()).add("values", "integer"))
    report = pca.pca_report(df.repartition(4)).orderBy("pc").collect()
    wanted = exact_ratios(dense(rows, width), 10)
    assert [r["ratio"] for r in report] == pytest.approx(wanted, abs=1e-6)
    assert {r["n_components"] for r in report} == {10}
    assert report[0]["total_explained"] == pytest.approx(wanted.sum(), abs=1e-5)


def test_report_of_little(spark):
    schema = StructType().add("features", VectorUDT())
    few = spark.createDataFrame([(Vectors.dense([1.0, 2.0]),), (Vectors.dense([2.0, 4.0]),)], schema)
    assert [r["ratio"] for r in pca.pca_report(few).orderBy("pc").collect()] == pytest.approx([1.0, 0.0])
    assert pca.pca_report(few.limit(0)).collect() == []
    same = spark.createDataFrame([(Vectors.dense([1.0, 2.0]),)] * 3, schema)
    assert [r["ratio"] for r in pca.pca_report(same).collect()] == [None, None]


def test_the_report_keeps_pairs_of_columns_and_not_rows(spark, monkeypatch):
    written = []

    def counted(df):
        out = settled(df)
        written.append(out.count())
        return out

    monkeypatch.setattr(pca, "settled", counted)
    rows = sparse_rows(600, 12, 7)
    df = spark.createDataFrame([(r,) for r in rows], StructType().add("features", VectorUDT()))
    paired = [r["ratio"] for r in pca.pca_report(df.repartition(3)).orderBy("pc").collect()]
    assert paired == pytest.approx(exact_ratios(dense(rows, 12), 10), abs=1e-6)
    # The twelve columns and one of ones make 91 pairs.
    assert written and max(written) <= 91
    # Rows with more entries than are paired are read in each pass, with the same result.
    monkeypatch.setattr(pca, "PAIRED_ENTRIES", 0)
    assert [r["ratio"] for r in pca.pca_report(df).orderBy("pc").collect()] == pytest.approx(paired, abs=1e-6)


def test_sums_of_products_are_handed_on_in_parts(spark, monkeypatch):
    monkeypatch.setattr(pca, "HELD_PRODUCTS", 50)
    monkeypatch.setattr(pca, "BLOCK_ENTRIES", 64)
    rows = sparse_rows(200, 40, 9)
    indices, values = [r.indices.tolist() for r in rows], [r.values.tolist() for r in rows]
    batch = pa.RecordBatch.from_arrays(
        [pa.array([40] * 200), pa.array(indices, pa.list_(pa.int32())), pa.array(values)], ["width", "indices", "values"]
    )
    parts = list(pca._products(iter([batch.slice(0, 90), batch.slice(90)])))
    assert len(parts) > 2
    found = np.zeros((41, 41))
    for part in parts:
        np.add.at(found, (part["i"].to_numpy(), part["j"].to_numpy()), part["v"].to_numpy())
    ones = np.hstack([np.ones((200, 1)), dense(rows, 40)])
    assert found == pytest.approx(np.triu(ones.T @ ones))
