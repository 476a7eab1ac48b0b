"""Registered queries over linear models: closed form, curve of a descent, bootstrap ensemble."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vanewatch.functions import scalars
from vanewatch.operators import linear, prepare, scoring
from vanewatch.plans.registry import query
from vanewatch.plans.series import CLIP, RUL, labelled, rounded
from vanewatch.plans.testviews import sql

L2 = 1e-4
STEPS, EPOCHS, RATE = 4, 6, 0.35
MEMBERS = 5
FEATURES = 2

_UNITS = (
    "select unit, row_number() over (order by md5(unit || ':42'), unit) <= ceil(0.2 * count(*) over ()) as held_out "
    "from (select distinct unit from t)"
)
_ROWS = (
    "select event_id, s2 / 500.0::double as a, cycle / 60.0::double as b, rul / {c}.0::double as y, "
    "1.0::double + 1.5::double * (rul / {c}.0::double) as w, held_out from r join u using (unit)"
).format(c=CLIP)
_SUMS = (
    "sum(w) as w, sum(w * a) as wa, sum(w * b) as wb, sum(w * a * a) as waa, sum(w * a * b) as wab, sum(w * b * b) as wbb, "
    "sum(w * y) as wy, sum(w * a * y) as way, sum(w * b * y) as wby, sum(w * y * y) as wyy"
)
# the intercept is eliminated by centring; the penalty stands on the two weights
_CENTRED = (
    f"select *, waa / w + {L2} - (wa / w) ** 2 as saa, wab / w - wa * wb / w / w as sab, wbb / w + {L2} - (wb / w) ** 2 as sbb, "
    "way / w - wa * wy / w / w as ta, wby / w - wb * wy / w / w as tb from sums"
)
_SOLVED = (
    "select *, wy / w - wa / w * m1 - wb / w * m2 as m0 from (select *, (ta * sbb - tb * sab) / (saa * sbb - sab * sab) as m1, "
    "(tb * saa - ta * sab) / (saa * sbb - sab * sab) as m2 from centred)"
)
_VIEWS = {"r": RUL, "u": _UNITS, "z": _ROWS}


def fit_rows(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Training and held-out readings with two features: a sensor, and the age."""
    y = scalars.normalized_target("rul", CLIP)
    vector = F.array(F.col("s2") / 500.0, F.col("cycle") / 60.0)
    rows = labelled(spark, sf_dir).select(
        "unit", "event_id", vector.alias("vector"), y.alias("y"), scalars.sample_weight(y).alias("weight")
    )
    return prepare.train_validation(rows)


@query(
    "rul_closed_form",
    sql(
        "select round(any_value(m0), 6) as bias, round(any_value(m1), 6) as w_sensor, round(any_value(m2), 6) as w_age, "
        "round(sqrt(avg((m0 + m1 * a + m2 * b - y) ** 2)), 6) as val_rmse, count(*) as held_out_rows from model, z where held_out",
        "t",
        **_VIEWS,
        sums=f"select {_SUMS} from z where not held_out",
        centred=_CENTRED,
        model=f"select m0, m1, m2 from ({_SOLVED})",
    ),
)
def rul_closed_form(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weighted ridge regression from one pass over the training rows."""
    train, held_out = fit_rows(spark, sf_dir)
    model = linear.fit_closed_form(train, FEATURES, L2)
    error, n = linear.mean_squared_error(held_out, FEATURES, model)
    row = (model.bias, *map(float, model.weights), error**0.5, n)
    result = spark.createDataFrame([row], "bias DOUBLE, w_sensor DOUBLE, w_age DOUBLE, val_rmse DOUBLE, held_out_rows BIGINT")
    return rounded(result, "bias", "w_sensor", "w_age", "val_rmse")


_STEP = (
    f"select s + 1 as s, m0 - {RATE} * (m0 * w + m1 * wa + m2 * wb - wy) / w as m0, "
    f"m1 - {RATE} * ((m0 * wa + m1 * waa + m2 * wab - way) / w + {L2} * m1) as m1, "
    f"m2 - {RATE} * ((m0 * wb + m1 * wab + m2 * wbb - wby) / w + {L2} * m2) as m2, "
    "m0 * m0 * w + 2 * m0 * m1 * wa + 2 * m0 * m2 * wb + m1 * m1 * waa + 2 * m1 * m2 * wab + m2 * m2 * wbb "
    "- 2 * (m0 * wy + m1 * way + m2 * wby) + wyy as err, w as used "
    f"from path join sums on k = s % {STEPS} where s < {STEPS * EPOCHS}"
)


@query(
    "training_curve",
    sql(
        "select epoch, round(loss, 6) as loss, round(val_rmse, 6) as val_rmse, val_rmse = min(val_rmse) over () as best from "
        f"(select s // {STEPS} as epoch, m0, m1, m2 from path where s > 0 and s % {STEPS} = 0) join "
        f"(select (s - 1) // {STEPS} + 1 as epoch, sum(err) / sum(used) as loss from path where s > 0 group by 1) using (epoch) join "
        f"(select s // {STEPS} as epoch, sqrt(avg((m0 + m1 * a + m2 * b - y) ** 2)) as val_rmse from path, z "
        f"where held_out and s > 0 and s % {STEPS} = 0 group by 1) using (epoch)",
        "t",
        **_VIEWS,
        sums=f"select event_id % {STEPS} as k, {_SUMS} from z where not held_out group by 1",
        path="select 0::bigint as s, 0::double as m0, 0::double as m1, 0::double as m2, 0::double as err, 0::double as used "
        f"union all {_STEP}",
    ).replace("with ", "with recursive ", 1),
)
def training_curve(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mini-batch descent: loss and held-out error per epoch, and the best epoch."""
    train, held_out = fit_rows(spark, sf_dir)
    batch = F.pmod(F.col("event_id"), F.lit(STEPS))
    curve = linear.descend(train, held_out, FEATURES, batch, STEPS, EPOCHS, RATE, L2)
    return rounded(linear.curve_rows(spark, curve), "loss", "val_rmse")


_TIMES = " + ".join(f"case when chance >= {level} then 1 else 0 end" for level in linear.POISSON_LEVELS)


@query(
    "bootstrap_confidence",
    sql(
        "select event_id, round(avg(m0 + m1 * a + m2 * b), 6) as y, round(stddev_pop(m0 + m1 * a + m2 * b), 6) as y_std, "
        "round_even(greatest(0, least(1, 1 - 10 * stddev_pop(m0 + m1 * a + m2 * b))), 3) as confidence "
        "from z, model where held_out group by event_id",
        "t",
        **_VIEWS,
        draws="select * exclude (w), w * times as w from (select *, " + _TIMES + " as times from (select z.*, member, "
        "('0x' || substr(md5(event_id || ':' || member || ':0'), 1, 8))::bigint / 4294967296.0::double as chance "
        f"from z, (select unnest(range({MEMBERS})) as member) where not held_out))",
        sums=f"select member, {_SUMS} from draws group by member",
        centred=_CENTRED,
        model=f"select member, m0, m1, m2 from ({_SOLVED})",
    ),
)
def bootstrap_confidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Models of resampled training rows; their spread gives every held-out reading a confidence."""
    train, held_out = fit_rows(spark, sf_dir)
    models = linear.fit_bootstrap(train, FEATURES, F.col("event_id"), MEMBERS, L2)
    scored = held_out.select("event_id", linear.member_scores("vector", models).alias("members"))
    summary = scoring.ensemble_summary(scored, "members").select("event_id", "y", "y_std", "confidence")
    return rounded(summary, "y", "y_std")
