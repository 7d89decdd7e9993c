"""Documents whose shape drifts: read as VARIANT, unknown fields kept, unreadable ones named."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aerolith.functions.clean import non_blank, sentinel_to_null

# Output column -> (path in the document, type) of an air-quality station document.
AIR_FIELDS: dict[str, tuple[str, str]] = {
    "station_id": ("stationID", "string"),
    "station_name_en": ("nameEN", "string"),
    "station_name_th": ("nameTH", "string"),
    "area_en": ("areaEN", "string"),
    "area_th": ("areaTH", "string"),
    "station_type": ("stationType", "string"),
    "lat": ("lat", "double"),
    "lon": ("long", "double"),
    "reading_date": ("AQILast.date", "string"),
    "reading_time": ("AQILast.time", "string"),
    "pm25_value": ("AQILast.PM25.value", "double"),
    "pm25_aqi": ("AQILast.PM25.aqi", "int"),
    "pm10_value": ("AQILast.PM10.value", "double"),
    "o3_value": ("AQILast.O3.value", "double"),
    "co_value": ("AQILast.CO.value", "double"),
    "no2_value": ("AQILast.NO2.value", "double"),
    "so2_value": ("AQILast.SO2.value", "double"),
    "overall_aqi": ("AQILast.AQI.aqi", "int"),
    "aqi_param": ("AQILast.AQI.param", "string"),
}


def _levels(fields: Mapping[str, tuple[str, str]]) -> dict[str, list[str]]:
    """Declared objects of the documents (by path, "" is the root) and the names declared in each."""
    known: dict[str, list[str]] = {"": []}
    for path, _ in fields.values():
        parts = path.split(".")
        for k, name in enumerate(parts):
            inside = known.setdefault(".".join(parts[:k]), [])
            if name not in inside:
                inside.append(name)
    return known


def unknown_fields(doc: Column, fields: Mapping[str, tuple[str, str]], is_object: Callable[[str], Column] | None = None) -> Column:
    """map<path, JSON text> of everything in the declared objects that no field declares.

    Places that ``is_object`` (if given) denies are not opened.
    """

    def inside(place: str, names: list[str]) -> Column:
        prefix = f"{place}." if place else ""
        fields_here = F.try_variant_get(doc, f"$.{place}" if place else "$", "map<string,variant>")
        if is_object:
            fields_here = F.when(is_object(place), fields_here)
        other = F.map_filter(fields_here, lambda k, v: ~k.isin(names))
        text = F.transform_values(F.transform_keys(other, lambda k, v: F.concat(F.lit(prefix), k)), lambda k, v: F.to_json(v))
        return F.coalesce(text, F.create_map().cast("map<string,string>"))

    return F.map_concat(*[inside(place, names) for place, names in _levels(fields).items()])


def _shape(fields: Mapping[str, tuple[str, str]]) -> tuple[dict, set[str]]:
    """The documents as nested dicts down to (column, type), and the columns that found a place of their own there.

    Left out are columns whose place, or one that differs by case alone, is
    taken by another one or by a declared object: a struct cannot name both.
    """
    shape, placed, levels = {}, set(), _levels(fields)
    for name, (path, kind) in fields.items():
        parts, node, steps = path.split("."), shape, []
        for part in parts[:-1]:
            steps.append((node, part))
            node = node.get(part, {})
        steps.append((node, parts[-1]))
        alike = any(k != part and k.lower() == part.lower() for at, part in steps for k in at)
        if alike or path in levels or parts[-1] in node:
            continue
        node = shape
        for part in parts[:-1]:
            node = node.setdefault(part, {})
        node[parts[-1]] = (name, kind)
        placed.add(name)
    return shape, placed


def _struct_type(shape: dict, as_variant: bool) -> str:
    def of(x) -> str:
        return _struct_type(x, as_variant) if isinstance(x, dict) else "variant" if as_variant else x[1]

    return "struct<" + ",".join(f"`{k}`:{of(x)}" for k, x in shape.items()) + ">"


def flatten_variant(
    raw: DataFrame,
    fields: Mapping[str, tuple[str, str]],
    value_col: str = "value",
    id_column: str | None = None,
    negative_is_missing: bool = True,
) -> DataFrame:
    """Every document as one row: the declared ``fields``, ``extras``, ``reasons`` and ``rejected``.

    A field that holds something its type cannot take (an object where a
    number is declared, text that is not one) is NULL and named in
    ``reasons`` as ``wrong type: <column>``; a number written as text, or text
    as a number, is read. A declared object's place that holds something else
    is named by its path. ``extras`` keeps fields nobody declared, at any
    declared depth, with their JSON. ``rejected`` rows are documents that are
    not JSON objects (``malformed``) or lack ``id_column`` (``missing id``).
    Each document is parsed once and walked once for all its values, once more
    for what they are there. Other columns of ``raw`` stay.
    """
    doc, values, found = F.col("__doc"), F.col("__values"), F.col("__found")
    shape, placed = _shape(fields)
    rows = raw.withColumn("__doc", F.try_parse_json(F.col(value_col).cast("string")))
    rows = rows.withColumns({c: F.try_variant_get(doc, "$", _struct_type(shape, c == "__found")) for c in ("__values", "__found")} if shape else {})

    def at(struct: Column, path: str) -> Column:
        for part in path.split(".") if path else []:
            struct = struct.getField(part)
        return struct

    def inside(place: str) -> Column:
        """Whether the place holds an object."""
        here = shape
        for part in place.split(".") if place else []:
            here = here.get(part, {})
        if here:
            return at(found, place).isNotNull()
        return F.coalesce(F.schema_of_variant(F.try_variant_get(doc, f"$.{place}" if place else "$", "variant")).startswith("OBJECT"), F.lit(False))

    is_object = inside("")
    columns, reasons = {}, [F.when(~is_object, F.lit("malformed"))]
    for name, (path, kind) in fields.items():
        value = at(values, path) if name in placed else F.try_variant_get(doc, f"$.{path}", kind)
        there = at(found, path) if name in placed else F.try_variant_get(doc, f"$.{path}", "variant")
        what = F.schema_of_variant(there)
        nested = F.coalesce(what.startswith("OBJECT") | what.startswith("ARRAY"), F.lit(False))
        given = there.isNotNull() & ~F.is_variant_null(there)
        reasons.append(F.when(given & (value.isNull() | nested), F.lit(f"wrong type: {name}")))
        value = F.when(~nested, value) if kind == "string" else value  # nothing nested is read as a number
        columns[name] = sentinel_to_null(value) if negative_is_missing and kind != "string" else value
    out = rows.withColumns(columns | {"extras": unknown_fields(doc, fields, inside)})
    for place in filter(None, _levels(fields)):
        there = F.try_variant_get(doc, f"$.{place}", "variant")
        reasons.append(F.when(~inside(place) & there.isNotNull() & ~F.is_variant_null(there), F.lit(f"wrong type: {place}")))
    if id_column:
        reasons.append(F.when(is_object & ~F.coalesce(non_blank(columns[id_column]), F.lit(False)), F.lit("missing id")))
    out = out.withColumn("reasons", F.array_compact(F.array(*reasons)))
    out = out.withColumn("rejected", F.arrays_overlap("reasons", F.array(F.lit("malformed"), F.lit("missing id"))))
    return out.drop("__doc", "__values", "__found", value_col)
