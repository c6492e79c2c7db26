"""Features, models and metrics: the demand forecast and the rare-class classifier."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from bizlens.operators import evaluation, features, forest, linear, models, summary
from bizlens.plans.registry import report
from bizlens.session import scratch_path
from bizlens.sources import readers, sinks

SERIES = ["store", "item"]
LAGS = "lag(units, 1) OVER s AS lag_1, lag(units, 7) OVER s AS lag_7"


@report("calendar_features", "M1", "order_id:i day:i month:i year:i week:i dayofweek:i", """
    SELECT order_id, day(order_date) AS day, month(order_date) AS month, year(order_date) AS year,
      weekofyear(order_date) AS week, isodow(order_date) - 1 AS dayofweek FROM ord""")
def _(t):
    return features.calendar_features(t.ord, "order_date")


@report("lag_features", "M2 W9", "store:s item:s day:s units:f lag_1:f lag_7:f",
        f"SELECT *, {LAGS} FROM demand WINDOW s AS (PARTITION BY store, item ORDER BY day)")
def _(t):
    return features.add_lags(t.demand, SERIES, "day", "units")


@report("rolling_features", "M2 W10", "store:s item:s day:s roll_3:f6 roll_7:f6 roll_30:f6", f"""
    SELECT store, item, day, {', '.join(f'''CASE WHEN count(units) OVER w{n} = {n} THEN CAST(sum(units) OVER w{n} AS DOUBLE) / {n}e0 END AS roll_{n}'''
                                        for n in (3, 7, 30))}
    FROM demand WINDOW {', '.join(f'w{n} AS (PARTITION BY store, item ORDER BY day ROWS BETWEEN {n} PRECEDING AND 1 PRECEDING)'
                                  for n in (3, 7, 30))}""")
def _(t):
    return features.add_rolling(t.demand, SERIES, "day", "units")


@report("standardized_lines", "M3 A16", "order_id:i line_no:i product_id:i qty:f6 total:f6", """
    SELECT order_id, line_no, product_id, (CAST(qty AS DOUBLE) - (SELECT avg(CAST(qty AS DOUBLE)) FROM line)) /
      (SELECT stddev_pop(CAST(qty AS DOUBLE)) FROM line) AS qty, (CAST(total AS DOUBLE) - (SELECT avg(CAST(total AS DOUBLE))
      FROM line)) / (SELECT stddev_pop(CAST(total AS DOUBLE)) FROM line) AS total FROM line""")
def _(t):
    return features.standardize(t.line, features.fit_standardizer(t.line, ["qty", "total"]))


@report("feature_matrix", "M4 P21", "doc_id:i label:f n_chars:f n_words:f n_lines:f avg_word:f6 digits:f quality:f", r"""
    SELECT doc_id, toxic AS label, n_chars, words AS n_words, len(string_split(text, chr(10))) AS n_lines,
      1e0 * length(text) / words AS avg_word, length(regexp_replace(text, '[^0-9]', '', 'g')) AS digits, quality
    FROM (SELECT *, len(string_split_regex(trim(text), '[ \t\n\v\f\r]+')) AS words FROM labels JOIN documents USING (doc_id)) x""")
def _(t):
    matrix = features.assemble(documents(t), FEATURES, "toxic", ["doc_id"])
    cells = vector_to_array("features")
    return matrix.select("doc_id", "label", *[F.get(cells, F.lit(i)).alias(name) for i, name in enumerate(FEATURES)])


@report("split_sizes", "M5", "toxic:i rows:i test_rows:i", """
    SELECT toxic, count(*) AS rows, CAST(ceil(0.2e0 * (count(*) - 1)) AS BIGINT) AS test_rows FROM labels GROUP BY 1""")
def _(t):
    train, test = features.stratified_split(t.raw("labels"), "toxic", "doc_id")
    both = train.withColumn("part", F.lit(0)).unionByName(test.withColumn("part", F.lit(1)))
    return both.groupBy("toxic").agg(F.count("*").alias("rows"), F.sum("part").alias("test_rows"))


@report("split_test_rows", "M5", "doc_id:i toxic:i", """
    SELECT doc_id, toxic FROM (SELECT *, row_number() OVER (PARTITION BY toxic ORDER BY md5(doc_id || ':42')) AS place,
      count(*) OVER (PARTITION BY toxic) AS n FROM labels) x WHERE place <= ceil(0.2e0 * (n - 1))""")
def _(t):
    return features.stratified_split(t.raw("labels"), "toxic", "doc_id")[1].select("doc_id", "toxic")


@report("time_split_sizes", "M6", "part:s days:i first_day:s last_day:s", """
    WITH c AS (SELECT DATE '1970-01-01' + CAST(trunc(quantile_cont(CAST(date_diff('day', DATE '1970-01-01', day) AS DOUBLE), 0.8))
      AS INTEGER) AS edge FROM demand)
    SELECT CASE WHEN day <= (SELECT edge FROM c) THEN 'train' ELSE 'test' END AS part, count(*) AS days, min(day) AS first_day,
      max(day) AS last_day FROM demand GROUP BY 1""")
def _(t):
    train, test = features.time_split(t.demand, "day")
    both = train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test")))
    return summary.summarize(both, ["part"], {"days": F.count("*"), "first_day": F.min("day"), "last_day": F.max("day")})


@report("class_balance", "M7 A21", "toxic:i n:i pct:f2", """
    SELECT toxic, count(*) AS n, 1e2 * count(*) / (SELECT count(toxic) FROM labels) AS pct FROM labels GROUP BY 1""")
def _(t):
    return summary.value_counts(t.raw("labels"), "toxic", normalize=True)


@report("class_weights", "M7", "doc_id:i toxic:i weight:f6", """
    SELECT doc_id, toxic, (SELECT count(*) FROM labels) / (2e0 * count(*) OVER (PARTITION BY toxic)) AS weight FROM labels""")
def _(t):
    return features.class_weights(t.raw("labels"), "toxic")


@report("oversampled_classes", "M7", "toxic:i n:i", """
    SELECT toxic, (SELECT max(n) FROM (SELECT count(*) AS n FROM labels GROUP BY toxic) m) AS n FROM (SELECT DISTINCT toxic FROM labels) l""")
def _(t):
    balanced = features.smote(documents(t), FEATURES, "toxic", "doc_id")
    return summary.value_counts(balanced, "toxic")


FEATURES = ["n_chars", "n_words", "n_lines", "avg_word", "digits", "quality"]


def documents(t):
    """Labelled documents with length features of the whole text."""
    words = F.size(F.split(F.trim("text"), r"\s+"))
    return t.raw("labels").join(t.raw("documents"), "doc_id").select(
        "doc_id", "toxic", F.col("quality").cast("double").alias("quality"), F.col("n_chars").cast("double").alias("n_chars"),
        words.cast("double").alias("n_words"), F.size(F.split("text", "\n")).cast("double").alias("n_lines"),
        (F.length("text") / words).alias("avg_word"),
        F.length(F.regexp_replace("text", "[^0-9]", "")).cast("double").alias("digits"))


def classified(t, kind):
    train, test = features.stratified_split(documents(t), "toxic", "doc_id")
    scaler = features.fit_standardizer(train, FEATURES)
    train, test = features.standardize(train, scaler), features.standardize(test, scaler)
    if kind == "logistic":
        model = linear.fit_log_odds(features.smote(train, FEATURES, "toxic", "doc_id"), FEATURES, "toxic")
        return model, models.predict(model, test, ["doc_id", F.col("toxic").alias("label")])
    weighted = features.class_weights(train, "toxic")
    model = models.fit_forest_classifier(weighted, FEATURES, "toxic", weight="weight")
    return model, models.score(model, test, ["doc_id", F.col("toxic").alias("label")])


@report("logistic_report", "M8 M10", "class:s precision:f recall:f f1:f support:i")
def _(t):
    return evaluation.classification_report(classified(t, "logistic")[1])


def _det(*rows):
    (a, b, c), (d, e, f), (g, h, i) = rows
    return f"({a}*({e}*{i}-{f}*{h})-{b}*({d}*{i}-{f}*{g})+{c}*({d}*{h}-{e}*{g}))"


#: Newton steps for two standardised features and an intercept, each one sum over all rows, solved by Cramer's rule.
_G = ["sum(p - y)", "sum((p - y) * x1) + b1", "sum((p - y) * x2) + b2"]
_H = {"00": "sum(q)", "01": "sum(q * x1)", "02": "sum(q * x2)", "11": "sum(q * x1 * x1) + 1", "12": "sum(q * x1 * x2)", "22": "sum(q * x2 * x2) + 1"}
_HS = [[f"h{min(i, j)}{max(i, j)}" for j in range(3)] for i in range(3)]
_MOVES = [f"b{k} - {_det(*[[f'g{i}' if j == k else _HS[i][j] for j in range(3)] for i in range(3)])} / {_det(*_HS)} AS b{k}" for k in range(3)]
NEWTON = r"""
    WITH RECURSIVE m AS (SELECT toxic AS y, CAST(n_chars AS DOUBLE) AS a, 1e0 * length(text) / words AS b
      FROM (SELECT *, len(string_split_regex(trim(text), '[ \t\n\v\f\r]+')) AS words FROM labels JOIN documents USING (doc_id)) x),
    d AS (SELECT y, (a - (SELECT avg(a) FROM m)) / (SELECT stddev_pop(a) FROM m) AS x1,
      (b - (SELECT avg(b) FROM m)) / (SELECT stddev_pop(b) FROM m) AS x2 FROM m),""" + f"""
    s AS (SELECT 0 AS step, 0e0 AS b0, 0e0 AS b1, 0e0 AS b2
      UNION ALL SELECT step + 1, {', '.join(_MOVES)} FROM (
        SELECT step, b0, b1, b2, {', '.join(f'{g} AS g{i}' for i, g in enumerate(_G))}, {', '.join(f'{h} AS h{n}' for n, h in _H.items())}
        FROM (SELECT *, p * (1 - p) AS q FROM (SELECT s.*, y, x1, x2, 1 / (1 + exp(-(b0 + b1 * x1 + b2 * x2))) AS p
          FROM s, d WHERE step < 20) z) q GROUP BY step, b0, b1, b2) h),
    fitted AS (SELECT * FROM s WHERE step = 20)"""
NEWTON_FEATURES = ["n_chars", "avg_word"]


def two_feature_fit(t):
    docs = documents(t)
    scaled = features.standardize(docs, features.fit_standardizer(docs, NEWTON_FEATURES))
    return linear.fit_log_odds(scaled, NEWTON_FEATURES, "toxic"), scaled


@report("logistic_coefficients", "M8", "name:s value:f6", f"""{NEWTON}
    SELECT '(intercept)' AS name, b0 AS value FROM fitted UNION ALL SELECT 'n_chars', b1 FROM fitted
    UNION ALL SELECT 'avg_word', b2 FROM fitted""")
def _(t):
    return two_feature_fit(t)[0].table(t.spark)


@report("logistic_confusion", "M8 M10", "label:i prediction:i n:i", f"""{NEWTON}
    SELECT label, prediction, count(*) AS n FROM (SELECT y AS label,
      CASE WHEN 1 / (1 + exp(-(b0 + b1 * x1 + b2 * x2))) >= 0.5 THEN 1 ELSE 0 END AS prediction FROM d, fitted) z GROUP BY ALL""")
def _(t):
    model, scaled = two_feature_fit(t)
    return evaluation.confusion_counts(models.predict(model, scaled, [F.col("toxic").alias("label")]))


@report("forest_report", "M9 M10", "class:s precision:f recall:f f1:f support:i")
def _(t):
    return evaluation.classification_report(classified(t, "forest")[1])


@report("forest_importance", "M13 M9", "feature:s importance:f")
def _(t):
    return models.feature_importance(classified(t, "forest")[0], FEATURES, t.spark)


#: A forest that SQL grows as well: trees, levels, bins and features looked at per split.
TREES, LEVELS, BINS, LOOKED_AT = 5, 3, 8, 2
_LIMITS = (24109, 48218, 60273, 64291, 65296, 65497, 65530)  # Poisson draws of mean 1 in parts of 65536


def forest_sql(rows: str, names: list[str], per_split: int | None, scored: str) -> str:
    """Nodes of the forest over ``rows`` (key, y and the features) and the scores of ``scored`` (key and the features)."""
    points = "[" + ", ".join(f"{i / BINS!r}" for i in range(1, BINS)) + "]"
    u = "('0x' || substr(md5(key || ':' || tree || ':42'), 1, 4))::INT"
    level = f"""
      l{{n}} AS MATERIALIZED ({{rows}}),
      h{{n}} AS (SELECT tree, node, f, bins[f + 1] AS bin, sum(w) AS w, sum(wy) AS wy FROM l{{n}}, range({len(names)}) r(f) GROUP BY ALL),
      c{{n}} AS (SELECT tree, node, f, bin, sum(w) OVER o AS wl, sum(wy) OVER o AS sl, sum(w) OVER p AS wt, sum(wy) OVER p AS st FROM h{{n}}
        WINDOW p AS (PARTITION BY tree, node, f), o AS (PARTITION BY tree, node, f ORDER BY bin)),
      g{{n}} AS (SELECT *, sl * sl / wl + (st - sl) * (st - sl) / (wt - wl) - st * st / wt AS gain FROM c{{n}} WHERE wl >= 1 AND wt - wl >= 1),
      t{{n}} AS (SELECT *, dense_rank() OVER (PARTITION BY tree, node ORDER BY md5(tree || ':' || node || ':' || f || ':42')) AS turn FROM g{{n}} WHERE gain > 1e-9),
      b{{n}} AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY tree, node ORDER BY gain DESC, f, bin) AS best FROM t{{n}}
        WHERE turn <= {per_split or len(names)} QUALIFY best = 1)"""
    parts = [level.format(n=0, rows="SELECT tree, 1::BIGINT AS node, w, w * y AS wy, bins FROM drawn WHERE w > 0")]
    for n in range(1, LEVELS):
        parts.append(level.format(n=n, rows=f"SELECT l.tree, l.node * 2 + (bins[f + 1] > bin)::INT AS node, w, wy, bins "
                                  f"FROM l{n - 1} l JOIN b{n - 1} b ON l.tree = b.tree AND l.node = b.node"))
    parts.append(f"""
      l{LEVELS} AS (SELECT l.tree, l.node * 2 + (bins[f + 1] > bin)::INT AS node, w, wy, bins
        FROM l{LEVELS - 1} l JOIN b{LEVELS - 1} b ON l.tree = b.tree AND l.node = b.node)""")
    edges = ", ".join(f"(SELECT list_sort(list_distinct(quantile_cont({f}, {points}))) FROM m) AS e{i}" for i, f in enumerate(names))
    cells = ", ".join(f"len(list_filter(e{i}, lambda e: e < {f}))" for i, f in enumerate(names))
    named = "[" + ", ".join(f"'{f}'" for f in names) + "]"
    totals = " UNION ALL ".join(
        f"SELECT s.tree, s.node, s.weight, s.total, {'b.f, b.bin, b.gain' if n < LEVELS else 'NULL, NULL, NULL'} FROM (SELECT tree, node, sum(w) AS weight, sum(wy) AS total "
        f"FROM l{n} GROUP BY ALL) s" + (f" LEFT JOIN b{n} b ON s.tree = b.tree AND s.node = b.node" if n < LEVELS else "") for n in range(LEVELS + 1))
    return f"""
    WITH RECURSIVE m AS MATERIALIZED ({rows}), edges AS MATERIALIZED (SELECT {edges}),
      drawn AS MATERIALIZED (SELECT tree, {' + '.join(f'({u} >= {x})::INT' for x in _LIMITS)} AS w, y, [{cells}] AS bins
        FROM m, edges, range(1, {TREES + 1}) r(tree)),{','.join(parts)},
      nodes AS MATERIALIZED (SELECT tree, node, weight, total, {named}[f + 1] AS feature, [{', '.join(f'e{i}' for i in range(len(names)))}][f + 1][bin + 1] AS threshold, gain
        FROM ({totals}) x(tree, node, weight, total, f, bin, gain), edges),
      asked AS MATERIALIZED ({scored}),
      walk AS (SELECT a.*, tree, 1::BIGINT AS node FROM asked a, (SELECT DISTINCT tree FROM nodes) t
        UNION ALL SELECT w.* EXCLUDE (node), w.node * 2 + (CASE feature {' '.join(f"WHEN '{f}' THEN {f}" for f in names)} END > threshold)::INT
        FROM walk w JOIN nodes n ON w.tree = n.tree AND w.node = n.node WHERE feature IS NOT NULL),
      scores AS (SELECT key, avg(total / weight) AS score FROM walk w JOIN nodes n ON w.tree = n.tree AND w.node = n.node WHERE feature IS NULL GROUP BY key)"""


_DOC_FEATURES = r"""SELECT doc_id::VARCHAR AS key, toxic AS y, CAST(n_chars AS DOUBLE) AS n_chars, CAST(words AS DOUBLE) AS n_words,
      CAST(len(string_split(text, chr(10))) AS DOUBLE) AS n_lines, 1e0 * length(text) / words AS avg_word,
      CAST(length(regexp_replace(text, '[^0-9]', '', 'g')) AS DOUBLE) AS digits, CAST(quality AS DOUBLE) AS quality
    FROM (SELECT *, len(string_split_regex(trim(text), '[ \t\n\v\f\r]+')) AS words FROM labels JOIN documents USING (doc_id)) x"""
_NOT_TEST = """doc_id NOT IN (SELECT doc_id FROM (SELECT *, row_number() OVER (PARTITION BY toxic ORDER BY md5(doc_id || ':42')) AS place,
      count(*) OVER (PARTITION BY toxic) AS n FROM labels) x WHERE place <= ceil(0.2e0 * (n - 1)))"""
CLASS_FOREST = forest_sql(f"{_DOC_FEATURES} WHERE {_NOT_TEST}", FEATURES, LOOKED_AT, f"{_DOC_FEATURES} WHERE NOT ({_NOT_TEST})")


def grown(t):
    """Nodes of the class forest on the training part, saved and read again, and the test part."""
    train, test = features.stratified_split(documents(t), "toxic", "doc_id")
    nodes = forest.grow_forest(train, FEATURES, "toxic", "doc_id", TREES, LEVELS, BINS, LOOKED_AT)
    return forest.load_forest(t.spark, forest.save_forest(nodes, scratch_path(t.spark, "class-forest"))), test


@report("forest_nodes", "M9 S11", "tree:i node:i weight:f total:f feature:s threshold:f6 gain:f6", f"{CLASS_FOREST} SELECT * FROM nodes")
def _(t):
    return grown(t)[0]


@report("forest_scores", "M9 S11", "doc_id:i score:f6", f"{CLASS_FOREST} SELECT key AS doc_id, score FROM scores")
def _(t):
    nodes, test = grown(t)
    return forest.score_forest(test, nodes, FEATURES, ["doc_id"])


@report("grown_importance", "M13", "feature:s importance:f6", f"""{CLASS_FOREST}
    SELECT feature, sum(part) / (SELECT count(DISTINCT tree) FROM nodes WHERE feature IS NOT NULL) AS importance FROM (
      SELECT feature, sum(gain) / (SELECT sum(gain) FROM nodes o WHERE o.tree = n.tree) AS part FROM nodes n
      WHERE feature IS NOT NULL GROUP BY tree, feature) p GROUP BY feature""")
def _(t):
    return forest.importances(grown(t)[0])


_GAPS = " + ".join(f"(a.{f} - b.{f}) * (a.{f} - b.{f})" for f in FEATURES)


@report("smote_neighbours", "M7", "doc_id:i place:i distance:f6", f"""
    WITH m AS ({_DOC_FEATURES} WHERE toxic = 1)
    SELECT doc_id, place, distance FROM (SELECT a.key AS doc_id, {_GAPS} AS distance,
      row_number() OVER (PARTITION BY a.key ORDER BY {_GAPS}) AS place FROM m a JOIN m b ON a.key <> b.key) x WHERE place <= 5""")
def _(t):
    return features.nearest_rows(documents(t).where("toxic = 1"), FEATURES, "doc_id")


@report("confusion_counts", "M10", "label:i prediction:i n:i",
        "SELECT label, prediction, count(*) AS n FROM scored GROUP BY ALL")
def _(t):
    return evaluation.confusion_counts(t.scored)


@report("classification_report", "M10", "class:s precision:f6 recall:f6 f1:f6 support:i", """
    WITH c AS (SELECT k AS class, count(*) FILTER (WHERE label = k) AS support, count(*) FILTER (WHERE prediction = k) AS predicted,
      count(*) FILTER (WHERE label = k AND prediction = k) AS hits FROM scored, (VALUES (0), (1)) v(k) GROUP BY 1),
    m AS (SELECT class, support, hits, coalesce(1e0 * hits / nullif(predicted, 0), 0) AS precision,
      coalesce(1e0 * hits / nullif(support, 0), 0) AS recall, coalesce(2e0 * hits / nullif(support + predicted, 0), 0) AS f1 FROM c)
    SELECT CAST(class AS VARCHAR) AS class, precision, recall, f1, support FROM m
    UNION ALL SELECT 'accuracy', 1e0 * sum(hits) / sum(support), 1e0 * sum(hits) / sum(support), 1e0 * sum(hits) / sum(support), sum(support) FROM m
    UNION ALL SELECT 'macro avg', avg(precision), avg(recall), avg(f1), sum(support) FROM m
    UNION ALL SELECT 'weighted avg', sum(precision * support) / sum(support), sum(recall * support) / sum(support),
      sum(f1 * support) / sum(support), sum(support) FROM m""")
def _(t):
    return evaluation.classification_report(t.scored)


@report("detected_and_missed", "M10", "detected:i missed:i", """
    SELECT count(*) FILTER (WHERE label = 1 AND prediction = 1) AS detected, count(*) FILTER (WHERE label = 1 AND prediction = 0) AS missed
    FROM scored""")
def _(t):
    return evaluation.detected_and_missed(t.scored)


@report("roc_auc", "M11", "roc_auc:f6", """
    SELECT avg(CASE WHEN p.score > n.score THEN 1e0 WHEN p.score = n.score THEN 0.5e0 ELSE 0e0 END) AS roc_auc
    FROM (SELECT score FROM scored WHERE label = 1) p, (SELECT score FROM scored WHERE label = 0) n""")
def _(t):
    return evaluation.roc_auc(t.scored)


@report("precision_recall_curve", "M12", "threshold:f tp:i fp:i precision:f6 recall:f6", """
    WITH s AS (SELECT score, count(*) FILTER (WHERE label = 1) AS p, count(*) FILTER (WHERE label = 0) AS n FROM scored GROUP BY 1),
    c AS (SELECT score AS threshold, sum(p) OVER w AS tp, sum(n) OVER w AS fp FROM s WINDOW w AS (ORDER BY score DESC))
    SELECT threshold, tp, fp, 1e0 * tp / (tp + fp) AS precision, 1e0 * tp / (SELECT sum(p) FROM s) AS recall FROM c""")
def _(t):
    return evaluation.pr_curve(t.scored)


COSTS = """SELECT k / 100e0 AS threshold, count(*) FILTER (WHERE label = 0 AND score >= k / 100e0) AS false_positives,
    count(*) FILTER (WHERE label = 1 AND score < k / 100e0) AS false_negatives,
    1000 * count(*) FILTER (WHERE label = 1 AND score < k / 100e0) + 50 * count(*) FILTER (WHERE label = 0 AND score >= k / 100e0) AS total_cost
    FROM scored, range(1, 100) r(k) GROUP BY k"""


@report("threshold_costs", "M14", "threshold:f false_positives:i false_negatives:i total_cost:i", COSTS)
def _(t):
    return evaluation.threshold_costs(t.scored)


@report("best_threshold", "M14", "threshold:f total_cost:i",
        f"SELECT threshold, total_cost FROM ({COSTS}) c ORDER BY total_cost, threshold LIMIT 1")
def _(t):
    return evaluation.best_threshold(evaluation.threshold_costs(t.scored))


def weekly(t):
    """Units per brand and week with lags and rolling means, complete rows only."""
    parts = t.line.groupBy("product_id", F.trunc("ship_date", "week").alias("week")).agg(F.sum("qty").alias("units"))
    named = parts.join(t.prod.select("part_id", "brand"), F.col("product_id") == F.col("part_id"))
    demand = named.groupBy("brand", "week").agg(F.sum("units").cast("double").alias("units"))
    lagged = features.add_lags(demand, ["brand"], "week", "units", [1, 7])
    return features.add_rolling(lagged, ["brand"], "week", "units", [7]).dropna()


DEMAND = ["lag_1", "lag_7", "roll_7"]


@report("forecast_inputs", "M2 M6 M17 P21", "brand:s week:s units:f lag_1:f lag_7:f roll_7:f6 part:s", """
    WITH d AS (SELECT brand, date_trunc('week', ship_date)::DATE AS week, sum(qty) AS units
      FROM line JOIN prod ON product_id = part_id GROUP BY ALL),
    f AS (SELECT *, lag(units, 1) OVER s AS lag_1, lag(units, 7) OVER s AS lag_7,
      CAST(sum(units) OVER (PARTITION BY brand ORDER BY week ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING) AS DOUBLE) / 7e0 AS roll_7
      FROM d WINDOW s AS (PARTITION BY brand ORDER BY week)),
    k AS (SELECT * FROM f WHERE lag_7 IS NOT NULL)
    SELECT *, CASE WHEN date_diff('day', DATE '1970-01-01', week) <= (SELECT trunc(quantile_cont(CAST(date_diff('day',
      DATE '1970-01-01', week) AS DOUBLE), 0.8)) FROM k) THEN 'train' ELSE 'test' END AS part FROM k""")
def _(t):
    train, test = features.time_split(weekly(t), "week")
    return train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test")))


def forecast(t, kind):
    """The library's forest keeps its 300 trees but stops at depth 8 here: with the operator's default of 30 levels
    the fit had not ended after 280 seconds on the 0.01 tables."""
    train, test = features.time_split(weekly(t), "week")
    if kind == "linear":
        return linear.fit_line(train, DEMAND, "units"), test
    return models.fit_forest_regressor(train, DEMAND, "units", depth=8), test


#: Complete weeks, the training part, and its least-squares line by Cramer's rule over the covariances.
_CELLS = [f"covar_pop({a}, {b}) AS {a}_{b}" for i, a in enumerate(DEMAND) for b in [*DEMAND[i:], "units"]]


_COV = [[f"{DEMAND[min(i, j)]}_{DEMAND[max(i, j)]}" for j in range(3)] for i in range(3)]
_WITH = [[[f"{DEMAND[i]}_units" if j == k else _COV[i][j] for j in range(3)] for i in range(3)] for k in range(3)]
LINE = f"""
    WITH d AS (SELECT brand, date_trunc('week', ship_date)::DATE AS week, CAST(sum(qty) AS DOUBLE) AS units
      FROM line JOIN prod ON product_id = part_id GROUP BY ALL),
    f AS (SELECT *, lag(units, 1) OVER s AS lag_1, lag(units, 7) OVER s AS lag_7,
      sum(units) OVER (PARTITION BY brand ORDER BY week ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING) / 7e0 AS roll_7
      FROM d WINDOW s AS (PARTITION BY brand ORDER BY week)),
    k AS (SELECT * FROM f WHERE lag_7 IS NOT NULL),
    e AS (SELECT trunc(quantile_cont(CAST(date_diff('day', DATE '1970-01-01', week) AS DOUBLE), 0.8)) AS edge FROM k),
    train AS (SELECT k.* FROM k, e WHERE date_diff('day', DATE '1970-01-01', week) <= edge),
    test AS (SELECT k.* FROM k, e WHERE date_diff('day', DATE '1970-01-01', week) > edge),
    v AS (SELECT {', '.join(_CELLS)}, {', '.join(f'avg({c}) AS m_{c}' for c in [*DEMAND, 'units'])} FROM train),
    w AS (SELECT *, {', '.join(f'{_det(*_WITH[k])} / {_det(*_COV)} AS w{k}' for k in range(3))} FROM v),
    fitted AS (SELECT *, m_units - w0 * m_lag_1 - w1 * m_lag_7 - w2 * m_roll_7 AS b FROM w),
    forecast AS (SELECT brand, week, units AS actual, b + w0 * lag_1 + w1 * lag_7 + w2 * roll_7 AS predicted FROM test, fitted)"""


@report("linear_coefficients", "M15", "name:s value:f6", f"""{LINE}
    SELECT '(intercept)' AS name, b AS value FROM fitted UNION ALL SELECT 'lag_1', w0 FROM fitted
    UNION ALL SELECT 'lag_7', w1 FROM fitted UNION ALL SELECT 'roll_7', w2 FROM fitted""")
def _(t):
    return forecast(t, "linear")[0].table(t.spark)


@report("linear_forecast", "M15 M17", "brand:s week:s actual:f predicted:f6", f"{LINE} SELECT * FROM forecast")
def _(t):
    model, test = forecast(t, "linear")
    return models.forecast_output(model, test, ["brand", "week"], "units")


@report("linear_forecast_errors", "M15 M18 S11", "rmse:f6 mape:f6 r2:f6", f"""{LINE}
    SELECT sqrt(sum((actual - predicted) ** 2) / count(*)) AS rmse, avg(abs((actual - predicted) / actual)) AS mape,
      1 - sum((actual - predicted) ** 2) / (var_pop(actual) * count(*)) AS r2 FROM forecast""")
def _(t):
    model, test = forecast(t, "linear")
    loaded = linear.Coefficients.load(t.spark, model.save(t.spark, scratch_path(t.spark, "linear-model")))
    return evaluation.regression_metrics(models.forecast_output(loaded, test, ["brand"], "units"))


@report("exported_forecast", "M17 S10 S11", "brand:s week:s actual:f predicted:f6", f"{LINE} SELECT * FROM forecast")
def _(t):
    """The predictions of the saved model, written as comma-separated text and read again."""
    model, test = forecast(t, "linear")
    loaded = linear.Coefficients.load(t.spark, model.save(t.spark, scratch_path(t.spark, "linear-model")))
    path = sinks.write_csv(models.forecast_output(loaded, test, ["brand", "week"], "units"), scratch_path(t.spark, "forecast"))
    return readers.read_csv(t.spark, path, "brand string, week date, actual double, predicted double")


@report("demand_correlation", "A24 M15", "x:s y:s correlation:f6", f"{LINE}, p AS (" + " UNION ALL ".join(
    f"SELECT '{a}' AS x, '{b}' AS y, corr({a}, {b}) AS correlation FROM train" for a in [*DEMAND, "units"] for b in [*DEMAND, "units"])
    + ") SELECT * FROM p")
def _(t):
    """Read from the sums that the line is fitted on."""
    train, _ = features.time_split(weekly(t), "week")
    return linear.gram(train, [*DEMAND, "units"], 6).correlations(t.spark)


@report("forest_forecast_errors", "M16 M17 M18", "rmse:f mape:f r2:f")
def _(t):
    model, test = forecast(t, "forest")
    return evaluation.regression_metrics(models.forecast_output(model, test, ["brand"], "units"))


_WEEKS = "SELECT brand || '|' || week AS key, units AS y, lag_1, lag_7, roll_7"
DEMAND_FOREST = forest_sql(f"{_WEEKS} FROM wk_train", DEMAND, None, f"{_WEEKS} FROM wk_test").replace(
    "WITH RECURSIVE", "WITH RECURSIVE " + LINE.split("WITH", 1)[1].split("v AS (SELECT")[0].rstrip().rstrip(",").replace(
        "train AS (", "wk_train AS (").replace("test AS (", "wk_test AS (").replace("    d AS", "    d AS") + ",", 1)


@report("grown_forecast", "M16 M17 S10 S11", "brand:s week:s predicted:f6", f"""{DEMAND_FOREST}
    SELECT string_split(key, '|')[1] AS brand, string_split(key, '|')[2] AS week, score AS predicted FROM scores""")
def _(t):
    """A forest for the demand, saved, read again, and its predictions written as comma-separated text."""
    train, test = (part.withColumn("key", F.concat_ws("|", "brand", "week")) for part in features.time_split(weekly(t), "week"))
    nodes = forest.grow_forest(train, DEMAND, "units", "key", TREES, LEVELS, BINS)
    loaded = forest.load_forest(t.spark, forest.save_forest(nodes, scratch_path(t.spark, "demand-forest")))
    scored = forest.score_forest(test, loaded, DEMAND, ["brand", "week"]).withColumnRenamed("score", "predicted")
    path = sinks.write_csv(scored, scratch_path(t.spark, "forest-forecast"))
    return readers.read_csv(t.spark, path, "brand string, week date, predicted double")


@report("naive_forecast_errors", "M18", "rmse:f6 mape:f6 r2:f6", """
    WITH p AS (SELECT CAST(units AS DOUBLE) AS a, CAST(lag(units) OVER (PARTITION BY store, item ORDER BY day) AS DOUBLE) AS p FROM demand),
    q AS (SELECT * FROM p WHERE p IS NOT NULL)
    SELECT sqrt(sum((a - p) * (a - p)) / count(*)) AS rmse, avg(abs((a - p) / a)) AS mape,
      1 - sum((a - p) * (a - p)) / (var_pop(a) * count(*)) AS r2 FROM q""")
def _(t):
    lagged = features.add_lags(t.demand, SERIES, "day", "units", [1]).where("lag_1 IS NOT NULL")
    return evaluation.regression_metrics(lagged, "units", "lag_1")
