"""Category labels and codes."""

from itertools import chain

from pyspark.sql import Column, functions as F, types as T

from thermolane.constants import ALLOWED_MODES, CATEGORY_CODES, DEFAULT_CODES


def _sql(value) -> str:
    if isinstance(value, list):
        return f"array({', '.join(map(_sql, value))})"
    return f"'{value}'" if isinstance(value, str) else str(value)


def _literal_map(pairs: dict) -> Column:
    return F.expr(f"map({', '.join(_sql(v) for v in chain.from_iterable(pairs.items()))})")


def category_key(x: Column) -> Column:
    return F.upper(F.trim(x.cast("string")))


def lookup_code(x: Column, kind: str) -> Column:
    """Code of a label (any case, surrounding blanks ignored) or of a numeric code; else null."""
    codes = CATEGORY_CODES[kind]
    by_label = F.try_element_at(_literal_map(codes), category_key(x))
    number = x.cast("string").try_cast("double")
    by_code = F.when(
        (F.typeof(x) != "string") & number.isin([float(c) for c in codes.values()]),
        number.cast("int"),
    )
    return F.coalesce(by_label, by_code)


def category_code(x: Column, kind: str, fill_nulls: bool = False) -> Column:
    """Code with the default for unknown labels; nulls stay null unless `fill_nulls`."""
    known = lookup_code(x, kind)
    default = F.lit(DEFAULT_CODES[kind])
    if fill_nulls:
        return F.coalesce(known, default)
    return F.when(x.isNotNull(), F.coalesce(known, default))


def strict_code(x: Column, kind: str) -> Column:
    """Code of an upper-cased label without trimming or default; unknown -> null."""
    return F.try_element_at(_literal_map(CATEGORY_CODES[kind]), F.upper(x))


def code_label(code: Column, kind: str) -> Column:
    """First label of a code; an unknown code as text."""
    labels = {}
    for label, value in CATEGORY_CODES[kind].items():
        labels.setdefault(value, label)
    return F.coalesce(
        F.try_element_at(_literal_map(labels), code.cast("int")), code.cast("string")
    )


def candidate_codes(candidates: Column, kind: str, preferred=()) -> Column:
    """Codes of a label or code array; none usable -> preferred labels, then all codes."""
    table = CATEGORY_CODES[kind]
    codes = F.filter(
        F.transform(candidates, lambda v: lookup_code(v, kind)), lambda v: v.isNotNull()
    )
    fallback = [table[p] for p in preferred if p in table] or list(table.values())
    return F.when(F.coalesce(F.size(codes), F.lit(0)) > 0, codes).otherwise(
        F.expr(_sql(fallback))
    )


def label_list(text: Column) -> Column:
    """Comma list -> array of trimmed labels."""
    return F.transform(F.split(text, ","), lambda v: F.trim(v))


def allowed_modes(operation_type: Column) -> Column:
    """Modes a pattern may have; null (no filter) for a missing or unknown type."""
    return F.try_element_at(_literal_map(ALLOWED_MODES), category_key(operation_type))


def target_mode(operation_type: Column) -> Column:
    """The mode an operation type prefers."""
    return F.try_element_at(
        _literal_map({k: CATEGORY_CODES["mode"][k] for k in ALLOWED_MODES}),
        category_key(operation_type),
    )


def on_off_flag(x: Column) -> Column:
    """0/1 switch: positive number -> 1; null or text that is no number -> 0."""
    return (F.coalesce(x.cast("string").try_cast("double"), F.lit(0.0)) > 0).cast("int")


def units_label(units: Column) -> Column:
    return F.when(units > 0, "ON").otherwise("OFF")


def status_code(units_on: Column, mode: Column) -> Column:
    """0 while no unit runs, else the mode for cooling and heating, else 3 (fan)."""
    return (
        F.when(F.coalesce(units_on, F.lit(0)) <= 0, 0)
        .when(mode == 1, 1)
        .when(mode == 2, 2)
        .otherwise(3)
    )


def effective_on(units: Column, state: Column) -> Column:
    """True when units run and the state (number, or the words ON/OFF) is positive."""
    text = state.cast("string")
    level = F.coalesce(
        text.try_cast("double"),
        F.try_element_at(_literal_map({"ON": 1.0, "OFF": 0.0}), F.upper(text)),
        F.lit(0.0),
    )
    return (F.coalesce(units.cast("double"), F.lit(0.0)) > 0) & (level > 0)


def weather_weights(hour: Column) -> Column:
    """Weights of temperature and sunshine: temperature only from 17:00 to 06:59."""
    return F.when(
        (hour >= 17) | (hour < 7),
        F.expr("named_struct('temperature', 1.0D, 'solar', 0.0D)"),
    ).otherwise(F.expr("named_struct('temperature', 0.7D, 'solar', 0.3D)"))


def codes_are_defined(codes: Column, kind: str) -> Column:
    """True when a set of codes holds defined codes only."""
    known = F.expr(_sql(list(CATEGORY_CODES[kind].values())))
    return F.size(F.array_except(codes.cast(T.ArrayType(T.IntegerType())), known)) == 0
