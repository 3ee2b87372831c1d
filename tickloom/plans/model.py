"""Model queries. The SQL counterparts take the same Newton steps, written out, from the same standardised features."""

from __future__ import annotations

from pyspark.sql import functions as F

from tickloom.functions.prices import to_price
from tickloom.ml import direction as M
from tickloom.ml import newton
from tickloom.operators import bars as B
from tickloom.plans.bars import bars_sql
from tickloom.plans.registry import query
from tickloom.plans.views import Tables
from tickloom.session import workspace

PENALTY = 1e-3
SQL_STEPS = 9


def _labelled(db: Tables):
    """Bars with decoded prices and the direction of the next one."""
    bars = B.next_bar_label(B.bars_from_ticks(db.view("v_spot"), "D1"))
    decoded = bars.withColumns({c: to_price(F.col(c)) for c in ("open", "high", "low", "close")})
    return M.feature_frame(decoded)


LABELLED = f"""
bars as ({bars_sql("D1")}),
labelled as (select *, lead(case when close > open then 1 else 0 end) over (partition by symbolId order by bar_time) as label from bars),
features as (select symbolId, bar_time, open / 100000.0::double as open, high / 100000.0::double as high, low / 100000.0::double as low,
                    close / 100000.0::double as close, volume::double as volume, label::double as label
             from labelled where label is not null)"""


@query("feature_frame", ("v_spot",), f"with {LABELLED} select * from features")
def feature_frame(db: Tables):
    return _labelled(db)


def _newton_sql() -> str:
    """The fit as common table expressions; each step sums over the rows and solves by Cholesky factors."""
    names, width = M.FEATURES, len(M.FEATURES) + 1
    z = ["1.0::double"] + [f"({f} - m_{f}) / d_{f}" for f in names]
    moments = ", ".join(f"avg({f}) as m_{f}, coalesce(nullif(stddev_pop({f}), 0), 1) as d_{f}" for f in names)
    parts = [
        LABELLED,
        "bucketed as (select *, (symbolId * 31 + date_diff('day', date '1970-01-01', bar_time::date) * 17) % 10 < 7 as train from features)",
        f"moments as (select count(*) as n, {moments} from bucketed where train)",
        f"z as materialized (select symbolId, bar_time, label, train, {', '.join(f'{x} as z{i}' for i, x in enumerate(z))} from bucketed, moments)",
        f"b0 as (select {', '.join(f'0::double as b{i}' for i in range(width))})",
    ]
    for step in range(1, SQL_STEPS + 1):
        margin = " + ".join(f"b{i} * z{i}" for i in range(width))
        sums = [f"sum((p - label) * z{i}) + {PENALTY if i else 0} * any_value(n) * any_value(b{i}) as g{i}" for i in range(width)]
        sums += [f"sum(p * (1 - p) * z{i} * z{j}) + {f'{PENALTY} * any_value(n)' if i == j and i else 0} as h{i}_{j}"
                 for i in range(width) for j in range(i + 1)]
        sums += [f"any_value(b{i}) as o{i}" for i in range(width)]
        solve = []  # one level of nesting each: an alias used beside its definition would be copied out again and again
        for j in range(width):
            root = f"sqrt(h{j}_{j}{''.join(f' - l{j}_{m} * l{j}_{m}' for m in range(j))})"
            below = [f"(h{i}_{j}{''.join(f' - l{i}_{m} * l{j}_{m}' for m in range(j))}) / {root} as l{i}_{j}" for i in range(j + 1, width)]
            solve.append(", ".join([f"{root} as l{j}_{j}", *below]))
        solve += [f"(g{i}{''.join(f' - l{i}_{m} * y{m}' for m in range(i))}) / l{i}_{i} as y{i}" for i in range(width)]
        solve += [f"(y{i}{''.join(f' - l{m}_{i} * x{m}' for m in range(i + 1, width))}) / l{i}_{i} as x{i}" for i in reversed(range(width))]
        solved = f"(from s{step})"
        for level in solve:
            solved = f"(select *, {level} from {solved})"
        parts += [
            f"s{step} as materialized (select {', '.join(sums)} from (select z.*, b.*, 1 / (1 + exp(-({margin}))) as p from z, b{step - 1} as b where train), moments)",
            f"b{step} as materialized (select {', '.join(f'o{i} - x{i} as b{i}' for i in range(width))} from {solved})",
        ]
    last = " + ".join(f"b{i} * z{i}" for i in range(width))
    parts.append(f"predicted as (select symbolId, bar_time, label, case when {last} > 0 then 1.0::double else 0.0::double end as prediction "
                 f"from z, b{SQL_STEPS} where not train)")
    return ",\n".join(parts)


NEWTON = _newton_sql()


def _fitted(db: Tables):
    train, test = M.split_rows(_labelled(db), "symbolId", "bar_time")
    return newton.fit(train, M.FEATURES, PENALTY), test


@query("lr_fit", ("v_spot",), f"with {NEWTON} select * from predicted")
def lr_fit(db: Tables):
    model, test = _fitted(db)
    return model.predict(test).select("symbolId", "bar_time", "label", "prediction")


@query("lr_coefficients", ("v_spot",), f"""with {NEWTON},
listed as (select unnest([{", ".join(f"'{n}'" for n in (newton.INTERCEPT, *M.FEATURES))}]) as feature,
                  unnest([{", ".join(f"b{i}" for i in range(len(M.FEATURES) + 1))}]) as c from b{SQL_STEPS})
select feature, cast(round(c * 1000000) as bigint) as millionths, true as settled from listed""")
def lr_coefficients(db: Tables):
    """Coefficients in millionths, and whether the gradient is zero there: the certificate of the fit."""
    model, _ = _fitted(db)
    return model.table(db.spark).select(
        "feature", F.round(F.col("coefficient") * 1_000_000).cast("bigint").alias("millionths"),
        (F.abs("gradient") < 1e-10).alias("settled"))


@query("lr_metrics", ("v_spot",), f"""with {NEWTON}
select avg(case when label = prediction then 1.0::double else 0.0::double end) as accuracy, count(*) as rows, '{PENALTY}' as penalty from predicted""")
def lr_metrics(db: Tables):
    """Scored test rows logged to a metrics table, model saved and loaded again."""
    root = workspace(db.spark, "model")
    model, test = _fitted(db)
    model.table(db.spark).write.parquet(f"{root}/model")
    loaded = newton.load(db.spark.read.parquet(f"{root}/model"))
    M.log_run(loaded.predict(test), {"penalty": str(PENALTY), "features": ",".join(M.FEATURES)}, f"{root}/runs")
    return db.spark.read.parquet(f"{root}/runs").select("accuracy", "rows", F.col("params")["penalty"].alias("penalty"))
