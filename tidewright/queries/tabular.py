"""Fit-and-apply features on the policy stand-in."""

from tidewright.operators.neighbours import neighbour_information
from tidewright.operators.tabular import LabelBinarizer, OneHot, Scaler, kinetic, kinetic_groups, mutual_information
from tidewright.queries.fixtures import policy, rounded, table, with_
from tidewright.queries.registry import query

_ID = "l_orderkey, l_linenumber, l_partkey, l_suppkey"


def _kin(name, cols):
    spread = " UNION ALL ".join(f"SELECT {_ID}, ps_reg_03, CAST({c} AS DOUBLE) AS v FROM policy" for c in cols)
    n = len(cols)
    return f"""{name} AS (SELECT {_ID}, ps_reg_03, sum(share * share) AS {name} FROM (SELECT {_ID}, ps_reg_03, v, count(*) / {n}.0::DOUBLE AS share
        FROM ({spread}) GROUP BY ALL) GROUP BY {_ID}, ps_reg_03)"""


@query(with_("policy", f""", {_kin('kinetic', ['ps_ind_03', 'ps_calc_01', 'ps_calc_02', 'ps_calc_03'])}
    SELECT {_ID}, round(kinetic, 9) AS kinetic FROM kinetic"""))
def kinetic_of_rows(spark, folder):
    out = kinetic(policy(spark, folder), ["ps_ind_03", "ps_calc_01", "ps_calc_02", "ps_calc_03"])
    return rounded(out.select(*_ID.split(", "), "kinetic"), 9)


@query(with_("policy", f""", {_kin('k1', ['ps_ind_03', 'ps_ind_15', 'ps_ind_06_bin'])}, {_kin('k2', ['ps_car_01_cat', 'ps_car_04_cat', 'ps_car_08_cat'])},
    {_kin('k3', ['ps_calc_01', 'ps_calc_02', 'ps_calc_03'])}, {_kin('k4', ['ps_calc_15_bin', 'ps_calc_16_bin', 'ps_calc_17_bin'])}
    SELECT {_ID}, round(k1, 5) AS kinetic_1, round(k2, 5) AS kinetic_2, round(k3, 5) AS kinetic_3, round(k4, 5) AS kinetic_4
    FROM k1 JOIN k2 USING ({_ID}, ps_reg_03) JOIN k3 USING ({_ID}, ps_reg_03) JOIN k4 USING ({_ID}, ps_reg_03)"""))
def kinetic_by_group(spark, folder):
    out = kinetic_groups(policy(spark, folder))
    return rounded(out.select(*_ID.split(", "), "kinetic_1", "kinetic_2", "kinetic_3", "kinetic_4"), 5)


@query(f"""WITH s AS (SELECT avg(l_quantity) AS mq, stddev_pop(l_quantity) AS sq, avg(l_extendedprice) AS mp, stddev_pop(l_extendedprice) AS sp FROM lineitem)
    SELECT {_ID}, round((l_quantity - mq) / sq, 6) AS l_quantity, round((l_extendedprice - mp) / sp, 6) AS l_extendedprice FROM lineitem, s""")
def scaled_columns(spark, folder):
    lines = table(spark, folder, "lineitem").select(*_ID.split(", "), "l_quantity", "l_extendedprice")
    return rounded(Scaler.fit(lines, ["l_quantity", "l_extendedprice"]).transform(lines), 6)


@query("""SELECT o_orderkey, CAST(o_orderstatus = 'F' AS INTEGER) AS o_orderstatus_F, CAST(o_orderstatus = 'O' AS INTEGER) AS o_orderstatus_O,
    CAST(o_orderstatus = 'P' AS INTEGER) AS o_orderstatus_P FROM orders""")
def one_hot_columns(spark, folder):
    orders = table(spark, folder, "orders").select("o_orderkey", "o_orderstatus")
    return OneHot.fit(orders, ["o_orderstatus"]).transform(orders)


@query("""SELECT o_orderkey, o_totalprice, CAST(coalesce(o_orderstatus = 'F', false) AS INTEGER) AS o_orderstatus_F,
    CAST(coalesce(o_orderstatus = 'O', false) AS INTEGER) AS o_orderstatus_O FROM orders""")
def one_hot_of_unseen_values(spark, folder):
    """Columns fitted on part of the data; the status P was not there."""
    orders = table(spark, folder, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus")
    return OneHot.fit(orders.filter("o_orderstatus <> 'P'"), ["o_orderstatus"]).transform(orders)


@query("""SELECT l_orderkey, l_linenumber, l_partkey, CAST(l_linestatus = 'O' AS INTEGER) AS l_linestatus, CAST(l_returnflag = 'A' AS INTEGER) AS l_returnflag_A,
    CAST(l_returnflag = 'N' AS INTEGER) AS l_returnflag_N, CAST(l_returnflag = 'R' AS INTEGER) AS l_returnflag_R FROM lineitem""")
def binarized_labels(spark, folder):
    lines = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_linestatus", "l_returnflag")
    return LabelBinarizer.fit(lines, ["l_linestatus", "l_returnflag"]).transform(lines)


def _mi(col):
    return f"""SELECT '{col}' AS feature, round(sum(n_vy / n * ln(n_vy * n / (n_v * n_y))), 9) AS mi FROM (SELECT CAST(count(*) AS DOUBLE) AS n_vy,
        CAST(sum(count(*)) OVER (PARTITION BY {col}) AS DOUBLE) AS n_v, CAST(sum(count(*)) OVER (PARTITION BY target) AS DOUBLE) AS n_y,
        CAST(sum(count(*)) OVER () AS DOUBLE) AS n FROM policy GROUP BY {col}, target)"""


@query(with_("policy", " UNION ALL ".join(_mi(c) for c in ("ps_ind_03", "ps_ind_15", "ps_car_01_cat", "ps_reg_01"))))
def mutual_information_with_target(spark, folder):
    return rounded(mutual_information(policy(spark, folder), ["ps_ind_03", "ps_ind_15", "ps_car_01_cat", "ps_reg_01"], "target"), 9)


def _psi(x):
    """Digamma of a whole number in SQL."""
    up = f"({x} + 6.0::DOUBLE)"
    shift = " - ".join(["", *[f"1 / ({x} + {i}.0::DOUBLE)" for i in range(6)]])
    return f"(ln({up}) - 0.5::DOUBLE / {up} - 1 / (12 * {up} ** 2) + 1 / (120 * {up} ** 4) - 1 / (252 * {up} ** 6) + 1 / (240 * {up} ** 8){shift})"


_NEAR = ", ".join(f"x - lag(x, {i}) OVER w, lead(x, {i}) OVER w - x" for i in (1, 2, 3))


@query(with_("policy", f""", long AS (SELECT 'ps_reg_03' AS feature, target AS y, CAST(ps_reg_03 AS DOUBLE) AS x FROM policy
        UNION ALL SELECT 'ps_car_13', target, ps_car_13 FROM policy UNION ALL SELECT 'ps_ind_15', target, ps_ind_15 FROM policy),
    sized AS (SELECT *, count(*) OVER (PARTITION BY feature, y) AS size FROM long QUALIFY size > 1),
    near AS (SELECT feature, x, size, least(3, size - 1) AS k, list_sort(list_filter([{_NEAR}], lambda v: v IS NOT NULL))[least(3, size - 1)] AS r
        FROM sized WINDOW w AS (PARTITION BY feature, y ORDER BY x)),
    cum AS (SELECT feature, x AS v, count(*) AS here, CAST(sum(count(*)) OVER (PARTITION BY feature ORDER BY x) AS BIGINT) AS upto FROM near GROUP BY feature, x),
    counted AS (SELECT q.feature, size, k, hi.upto - coalesce(lo.upto, 0) AS m FROM near q ASOF JOIN cum hi ON q.feature = hi.feature AND q.x + r > hi.v
          ASOF LEFT JOIN cum lo ON q.feature = lo.feature AND q.x - r >= lo.v WHERE r > 0
        UNION ALL SELECT q.feature, size, k, here FROM near q JOIN cum ON q.feature = cum.feature AND q.x = v WHERE r = 0)
    SELECT feature, round(greatest(0.0::DOUBLE, {_psi('count(*)')} + avg({_psi('k')}) - avg({_psi('size')}) - avg({_psi('m')})), 6) AS mi FROM counted GROUP BY feature"""))
def neighbour_information_with_target(spark, folder):
    """The published estimator: third neighbour of the same class."""
    return rounded(neighbour_information(policy(spark, folder), ["ps_reg_03", "ps_car_13", "ps_ind_15"], "target"), 6)


@query()
def mutual_information_of_bins(spark, folder):
    """Quantile bins are approximate, so only rows are checked here; a test compares with exact bins."""
    return mutual_information(policy(spark, folder), ["ps_reg_03", "ps_car_13"], "target", bins=16)


@query()
def policy_model_input(spark, folder):
    """Products, scaling, binarising and kinetic scores, fitted on one part and applied to another."""
    from tidewright.operators.joins import glue
    from tidewright.operators.order import row_index
    from tidewright.operators.select import add_products, column_roles, sample_fraction
    from tidewright.operators.tabular import FeatureTable

    df = row_index(policy(spark, folder), ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "ps_reg_03"], "id")
    df = df.drop("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    made = add_products(df, {"mult": ["ps_reg_01", "ps_reg_03", "ps_reg_02"]})
    fitted = FeatureTable.fit(sample_fraction(made, 0.8, "id", 17), column_roles(made.drop("id", "target")))
    scores = kinetic_groups(df.drop("target")).select("id", "kinetic_1", "kinetic_2", "kinetic_3", "kinetic_4")
    return glue(fitted.transform(made), scores, "id")
