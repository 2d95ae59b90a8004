"""Plans and passes of queries that grow with the input."""

from pyspark.sql import functions as F

TEXTS = [(1, "ab cd ab ef"), (2, "ab cd gh"), (3, "ab gh cd"), (3, "cd ab cd"), (4, None), (5, "ab cd ef ef")]


def counted(spark, df, name):
    """``df`` whose column ``name`` counts the rows that pass in an accumulator."""
    seen = spark.sparkContext.accumulator(0)

    def look(x):
        seen.add(1)
        return x
    return df.withColumn(name, F.udf(look, df.schema[name].dataType).asNondeterministic()(name)), seen


def test_tfidf_moves_no_terms(spark):
    from tabkit.operators.textops import tfidf
    docs = spark.createDataFrame(TEXTS, "doc_id long, text string")
    out = tfidf(docs, "doc_id", "text", min_df=2, max_features=4)
    plan = out._jdf.queryExecution().executedPlan().toString()
    moved = [line for line in plan.splitlines() if " Exchange " in line]
    assert moved and all("REPARTITION" in line and "term" not in line for line in moved), plan
    rows = {(r["doc_id"], r["term"]): r["weight"] for r in out.collect()}
    # a key on two rows is one document
    assert {t for k, t in rows if k == 3} == {"ab", "cd", "ab cd"} and 4 not in {k for k, _ in rows}
    for k in (1, 2, 3, 5):
        assert abs(sum(w * w for (d, _), w in rows.items() if d == k) - 1) < 1e-12


def test_svd_reads_its_weights_once(spark):
    from tabkit.operators.features import tfidf_svd
    cells = [(d, f"t{j}", float(1 + (d * j) % 5)) for d in range(12) for j in range(8) if (d + j) % 3]
    long, seen = counted(spark, spark.createDataFrame(cells, "doc_id long, term string, weight double"), "term")
    out = tfidf_svd(long, "doc_id", k=2).collect()
    assert seen.value == len(cells)
    assert {r["doc_id"] for r in out} == set(range(12))
    assert all(abs(sum(x * x for x in r["svd"]) - 1) < 1e-9 for r in out)


def test_folds_read_their_rows_once(spark):
    from pyspark.ml import Pipeline
    from pyspark.ml.evaluation import RegressionEvaluator
    from pyspark.ml.feature import StandardScaler, VectorAssembler
    from pyspark.ml.regression import LinearRegression
    from pyspark.ml.tuning import CrossValidator

    from tabkit.operators.models import cross_validate
    plain = spark.createDataFrame([(float(i), 3.0 * i + i % 4, i % 3) for i in range(60)], "x double, label double, fold int")
    df, seen = counted(spark, plain, "x")
    lr = LinearRegression()
    pipe = Pipeline(stages=[VectorAssembler(inputCols=["x"], outputCol="raw"),
                            StandardScaler(inputCol="raw", outputCol="features", withMean=True), lr])
    maps = [{lr.regParam: v} for v in (0.0, 5.0)]
    got = cross_validate(pipe, maps, df, RegressionEvaluator(), fold_col="fold")
    assert seen.value == 60
    want = CrossValidator(estimator=pipe, estimatorParamMaps=maps, evaluator=RegressionEvaluator(), foldCol="fold").fit(plain)
    for a, b in zip(got.avgMetrics + got.stdMetrics, want.avgMetrics + want.stdMetrics, strict=True):
        assert abs(a - b) < 1e-9
    assert abs(got.bestModel.stages[-1].coefficients[0] - want.bestModel.stages[-1].coefficients[0]) < 1e-9


def test_importance_moves_rows_once_a_repeat(spark):
    from pyspark.ml import Pipeline
    from pyspark.ml.evaluation import RegressionEvaluator
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import LinearRegression

    from tabkit.operators.models import permutation_importance
    feats = ["a", "b", "c"]
    plain = spark.createDataFrame([(i, float(i % 7), float(i % 5), float(i % 3), 9.0 * (i % 7) + i % 5) for i in range(80)],
                                  "key long, a double, b double, c double, label double")
    model = Pipeline(stages=[VectorAssembler(inputCols=feats, outputCol="features"), LinearRegression()]).fit(plain)
    df, seen = counted(spark, plain, "b")
    out = {r["feature"]: r for r in permutation_importance(model, df, "key", feats, RegressionEvaluator(), repeats=2).collect()}
    assert seen.value <= 2 * 80  # the range bounds and the layout
    assert out["a"]["mean_importance"] > out["b"]["mean_importance"] > abs(out["c"]["mean_importance"])


def test_importance_of_repeated_and_null_keys(spark):
    from pyspark.ml import Pipeline
    from pyspark.ml.evaluation import RegressionEvaluator
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import LinearRegression

    from tabkit.operators.models import permutation_importance
    rows = [(None if i % 9 == 4 else i // 2, float(i), 2.0 * i) for i in range(40)]
    df = spark.createDataFrame(rows, "key long, a double, label double")
    model = Pipeline(stages=[VectorAssembler(inputCols=["a"], outputCol="features"), LinearRegression()]).fit(df)
    out = permutation_importance(model, df, "key", ["a"], RegressionEvaluator(), repeats=2).collect()
    assert len(out) == 1 and out[0]["mean_importance"] > 1


def test_stacking_reads_its_rows_once(spark):
    from pyspark.ml.regression import LinearRegression

    from tabkit.operators import stacking as ST
    plain = spark.createDataFrame([(i, float(i % 11), float(i % 5), 2.0 * (i % 11) + i % 5) for i in range(90)],
                                  "key long, q double, z double, label double")
    df, seen = counted(spark, plain, "q")
    bases = [ST.Base("one", LinearRegression(solver="normal"), ["q"]), ST.Base("two", LinearRegression(solver="normal"), ["z"])]
    model = ST.fit_stacking(df, ["key"], "label", bases, 3, 0.0)
    assert seen.value == 90
    err = model.transform(plain).select(F.max(F.abs(F.col("prediction") - F.col("label")))).first()[0]
    assert err < 1.0


def test_candidates_read_their_rows_once(spark):
    from tabkit.operators.models import candidate_cv
    rows = [(p, f, float(1 + (p + f) % 4), float(10 * p + f + 1)) for p in range(6) for f in range(5) for _ in range(2) if p or f == 0]
    plain = spark.createDataFrame(rows + [(None, 1, 2.0, 7.0)], "l_partkey long, fold int, l_quantity double, l_extendedprice double")
    df, seen = counted(spark, plain, "l_extendedprice")
    got = {r["model"]: r["cv_rmse"] for r in candidate_cv(df).collect()}
    assert seen.value == len(rows) + 1
    every = rows + [(None, 1, 2.0, 7.0)]

    def mean_price(keep):
        kept = [y / q for p, f, q, y in every if keep(p, f)]
        return sum(kept) / len(kept) if kept else None
    errors = {"baseline": {}, "per_part": {}}
    for p, f, q, y in rows:
        base = mean_price(lambda _, g, f=f: g != f)
        part = mean_price(lambda o, g, p=p, f=f: o == p and g != f)
        errors["baseline"].setdefault(f, []).append((y - q * base) ** 2)
        errors["per_part"].setdefault(f, []).append((y - q * (base if part is None else part)) ** 2)
    for name, by in errors.items():
        want = sum((sum(e) / len(e)) ** 0.5 for e in by.values()) / len(by)
        assert abs(got[name] - want) < 1e-9


def test_regressors_and_attribution_land_their_rows(spark, sf_dir, monkeypatch):
    """The fits read landed columns: no join, no text and no shuffle is in their input."""
    from tabkit.operators import models as MD
    from tabkit.plans import ml_plans as P
    seen, make, fit_text = [], MD.make_estimator, MD.fit_text_logistic

    class Watched:
        def __init__(self, inner):
            self.inner = inner

        def fit(self, d):
            seen.append(d._jdf.queryExecution().executedPlan().toString())
            return self.inner.fit(d)

    def watched_text(df, *args, **kwargs):
        seen.append(df._jdf.queryExecution().executedPlan().toString())
        return fit_text(df, *args, **kwargs)
    monkeypatch.setattr(MD, "make_estimator", lambda *a, **k: Watched(make(*a, **k)))
    monkeypatch.setattr(MD, "fit_text_logistic", watched_text)
    assert P.a05(spark, sf_dir).count() == 3
    assert P.a17(spark, sf_dir).count() == 20
    assert len(seen) == 4 and not any("Join" in p or "Exchange" in p for p in seen)


def test_tokens_of_ascii_and_accented_texts(spark):
    from tabkit.functions import text as TX
    texts = ["The CAT_s cat9 a ab, ab-cd x", "Ação É über\u0130 naïve \u4e2d\u6587ab cd", "", None, "abc"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, text string")
    toks = TX.tokens("text", 2)
    plan = df.select(toks)._jdf.queryExecution().optimizedPlan().toString()
    assert "lambda" not in plan
    got = {r["i"]: r["t"] for r in df.select("i", toks.alias("t")).collect()}
    assert got[0] == ["the", "ab", "ab", "cd"] and got[2] == [] and got[3] == [] and got[4] == ["abc"]
    assert got[1] == ["acao", "uberi", "naive", "ab", "cd"]
    kept = df.where("i = 0").select(TX.remove_stopwords(toks, [f"w{i}" for i in range(20)] + ["ab"]).alias("k"))
    assert "array_contains" not in kept._jdf.queryExecution().optimizedPlan().toString()
    assert kept.first()["k"] == ["the", "cd"]


def test_medians_meet_the_rows_without_a_shuffle(spark):
    from tabkit.operators.features import GroupMedianImputer
    df = spark.createDataFrame([("a", 1.0), ("a", 3.0), ("a", None), ("b", None), (None, None), (None, 7.0)], "g string, x double")
    out = GroupMedianImputer("g", ["x"]).fit(df).transform(df)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan, plan
    assert sorted((r["g"] or "", r["x"]) for r in out.collect()) == [
        ("", 3.0), ("", 7.0), ("a", 1.0), ("a", 2.0), ("a", 3.0), ("b", 3.0)]
