"""Alert conditions over query results."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewell.operators.skew import apart, drop_apart

# Operator names and the sign shown for each.
SIGNS = {
    "EQUAL": "=",
    "GREATER_THAN": ">",
    "GREATER_THAN_OR_EQUAL": "≥",
    "LESS_THAN": "<",
    "LESS_THAN_OR_EQUAL": "≤",
    "NOT_EQUAL": "≠",
}


#: Type in which integers and decimals are compared and shown: whole part and the rest, of the same sign.  Every
#: decimal type fits without rounding, and structs compare field by field as the numbers do.
EXACT = "struct<whole: decimal(38,0), rest: decimal(38,38)>"


def exact_value(value: Column, data_type: T.DataType) -> Column:
    """An integer or decimal as ``EXACT``."""
    value = value if isinstance(data_type, T.DecimalType) else value.cast("decimal(20,0)")
    return F.when(value.isNotNull(), F.struct(
        F.when(F.signum(value) < 0, F.ceil(value)).otherwise(F.floor(value)).cast("decimal(38,0)").alias("whole"),
        (value % F.lit(1).cast("decimal(1,0)")).cast("decimal(38,38)").alias("rest")))


def exact_operand(operand: Column, data_type: T.DataType) -> Column:
    """A number given as an operand as ``EXACT``; null where a double is too large for that.

    Doubles mean the decimal they are written as: 0.1 is a tenth.
    """
    if isinstance(data_type, (T.IntegralType, T.DecimalType)):
        return exact_value(operand, data_type)
    text = operand.cast("string")
    usual, small, whole = (text.try_cast(kind) for kind in ("decimal(38,18)", "decimal(38,38)", "decimal(38,0)"))
    none = F.lit(0)
    made = F.struct(F.when(usual < 0, F.ceil(usual)).otherwise(F.floor(usual)).cast("decimal(38,0)").alias("whole"),
                    (usual % F.lit(1).cast("decimal(1,0)")).cast("decimal(38,38)").alias("rest"))
    return (F.when(F.abs(operand) < 1, F.struct(none.cast("decimal(38,0)").alias("whole"), small.alias("rest")))
            .when(usual.isNotNull(), made)
            .when(whole.isNotNull(), F.struct(whole.alias("whole"), none.cast("decimal(38,38)").alias("rest"))))


def number_text(value: Column) -> Column:
    """A number as shown in messages: whole values of any size without decimals."""
    whole = value.try_cast("decimal(38,0)")
    return F.when(whole == value, whole.cast("string")).otherwise(value.cast("string"))


def exact_text(value: Column) -> Column:
    """An exact value as shown in messages, without trailing zeros."""
    whole, rest = value["whole"], value["rest"]
    # Compared with zero, a decimal of this scale would be rounded first; its sign is not.
    sign = F.when((whole == 0) & (F.signum(rest) < 0), "-").otherwise("")
    digits = F.rtrim(F.substring(F.to_char(F.abs(rest), F.lit("0D" + "0" * 38)), 3, 38), F.lit("0"))
    return F.when(F.signum(rest) == 0, whole.cast("string")).otherwise(F.concat(sign, whole.cast("string"), F.lit("."), digits))


def flag_text(value: Column) -> Column:
    return F.initcap(value.cast("string"))


def first_row_values(query_id: str, result: DataFrame) -> DataFrame:
    """The first row of a query result, one output row per column.

    ``query_id, column_name, exact_value, number_value, text_value, flag_value``: integers
    and decimals are exact values, floating numbers are doubles.  No rows when the
    result is empty.
    """
    def entry(field: T.StructField) -> Column:
        column = F.col(f"`{field.name}`")
        exact = isinstance(field.dataType, (T.IntegralType, T.DecimalType))
        number = isinstance(field.dataType, T.FractionalType) and not exact
        flag = isinstance(field.dataType, T.BooleanType)
        return F.struct(
            F.lit(field.name).alias("column_name"),
            (exact_value(column, field.dataType) if exact else F.lit(None)).cast(EXACT).alias("exact_value"),
            (column.cast("double") if number else F.lit(None).cast("double")).alias("number_value"),
            (F.lit(None).cast("string") if exact or number or flag else column.cast("string")).alias("text_value"),
            (column if flag else F.lit(None).cast("boolean")).alias("flag_value"),
        )

    return result.limit(1).select(F.lit(query_id).alias("query_id"),
                                  F.inline(F.array(*[entry(field) for field in result.schema.fields])))


def evaluate_alerts(alerts: DataFrame, values: DataFrame) -> DataFrame:
    """Compare each alert's column with its operand.

    ``alerts``: ``alert_id, query_id, column_name, operator``, the operand as one
    of ``number_operand, text_operand, flag_operand`` and ``empty_triggers``.
    ``values``: as :func:`first_row_values`, one row per query and column; a second
    one is an error.  Exact values are compared exactly, whatever their size and scale, with the operand in the
    same form (as doubles only if a double operand passes 38 digits); ``exact_value`` may be left out.  A
    query with no rows takes ``empty_triggers``.  A null value triggers only
    ``IS_NULL``, or ``EQUAL`` when the alert has no operand either.
    """
    if "exact_value" not in values.columns:
        values = values.withColumn("exact_value", F.lit(None).cast(EXACT))
    keyed = drop_apart(apart(values, ["query_id", "column_name"]).agg(
        F.when(F.count(F.lit(1)) > 1, F.raise_error(F.lit("several values of one query and column"))).otherwise(
            F.first(F.struct("exact_value", "number_value", "text_value", "flag_value"))).alias("v")))
    joined = alerts.join(keyed, ["query_id", "column_name"], "left")
    v = F.col("v")

    def compare(value: Column, operand: Column) -> Column:
        return (F.when(F.col("operator") == "EQUAL", value == operand)
                .when(F.col("operator") == "NOT_EQUAL", value != operand)
                .when(F.col("operator") == "GREATER_THAN", value > operand)
                .when(F.col("operator") == "GREATER_THAN_OR_EQUAL", value >= operand)
                .when(F.col("operator") == "LESS_THAN", value < operand)
                .when(F.col("operator") == "LESS_THAN_OR_EQUAL", value <= operand))

    operand_type = alerts.schema["number_operand"].dataType
    operand_value = exact_operand(F.col("number_operand"), operand_type)
    missing = v["exact_value"].isNull() & v["number_value"].isNull() & v["text_value"].isNull() & v["flag_value"].isNull()
    met = (F.when(F.col("operator") == "IS_NULL", missing)
           .when(operand_value.isNotNull() & v["exact_value"].isNotNull(), compare(v["exact_value"], operand_value))
           .when(F.col("number_operand").isNotNull() & v["exact_value"].isNotNull(),
                 compare(v["exact_value"]["whole"].cast("double"), F.col("number_operand").cast("double")))
           .when(F.col("number_operand").isNotNull(), compare(v["number_value"], F.col("number_operand").cast("double")))
           .when(F.col("flag_operand").isNotNull(), compare(v["flag_value"], F.col("flag_operand")))
           .when(F.col("text_operand").isNotNull(), compare(v["text_value"], F.col("text_operand")))
           .when(F.col("operator") == "EQUAL", missing)
           .when(F.col("operator") == "NOT_EQUAL", ~missing))
    triggered = F.when(v.isNull(), F.col("empty_triggers")).otherwise(F.coalesce(met, F.lit(False)))

    decimal_operand = isinstance(operand_type, (T.IntegralType, T.DecimalType))
    shown = F.coalesce(exact_text(v["exact_value"]), number_text(v["number_value"]), flag_text(v["flag_value"]), v["text_value"])
    number = F.col("number_operand")
    operand = F.coalesce(exact_text(operand_value) if decimal_operand else number_text(number), flag_text(F.col("flag_operand")),
                         F.col("text_operand"))
    sign = F.lit(None).cast("string")
    for name, symbol in SIGNS.items():
        sign = F.when(F.col("operator") == name, symbol).otherwise(sign)
    is_null = F.concat("column_name", F.lit(" IS NULL"))
    return joined.select(
        "alert_id", "query_id", "column_name", "operator", triggered.alias("triggered"),
        F.when(v.isNull(), F.lit(None)).otherwise(
            F.when(missing, is_null).otherwise(F.concat_ws(" = ", "column_name", shown))).alias("alert_result"),
        F.when(F.col("operator") == "IS_NULL", is_null)
        .otherwise(F.concat_ws(" ", "column_name", sign, F.coalesce(operand, F.lit("NULL")))).alias("condition_text"),
    )
