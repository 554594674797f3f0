"""Policy table to model input: products, dropped columns, scaling, binarising, kinetic scores."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tidewright.operators.joins import glue
from tidewright.operators.select import add_products, column_roles, drop_cols
from tidewright.operators.tabular import FeatureTable, kinetic_groups

# Columns left out for their low value.
LOW_VALUE = (
    "ps_calc_01", "ps_calc_02", "ps_calc_03", "ps_calc_04", "ps_calc_05", "ps_calc_06", "ps_calc_07", "ps_calc_08",
    "ps_calc_09", "ps_calc_10", "ps_calc_11", "ps_calc_12", "ps_calc_13", "ps_calc_14", "ps_calc_15_bin",
    "ps_calc_16_bin", "ps_calc_17_bin", "ps_calc_18_bin", "ps_calc_19_bin", "ps_calc_20_bin", "ps_car_10_cat",
    "ps_ind_10_bin", "ps_ind_13_bin", "ps_ind_12_bin",
)
# The three interaction columns.
PRODUCTS = {
    "mult": ["ps_reg_01", "ps_reg_03", "ps_reg_02"],
    "ps_car": ["ps_car_13", "ps_reg_03", "ps_car_13"],
    "ps_ind": ["ps_ind_03", "ps_ind_15"],
}


def policy_features(train: DataFrame, test: DataFrame, key: str = "id", compat: bool = False) -> tuple[DataFrame, DataFrame]:
    """Model input of both tables, fitted on the training table only."""
    def prepare(df):
        return drop_cols(add_products(df, PRODUCTS), LOW_VALUE)

    ready = prepare(train)
    roles = column_roles(ready.drop(key, "target"))
    fitted = FeatureTable.fit(ready, roles)
    scores = ["kinetic_1", "kinetic_2", "kinetic_3", "kinetic_4"]

    def features(df):
        kin = kinetic_groups(df.drop("target"), compat).select(key, *scores)
        return glue(fitted.transform(prepare(df)), kin, key)

    return features(train), features(test)
