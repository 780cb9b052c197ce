"""Scalar expressions over columns."""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, DoubleType, StringType, StructType


def nan_to_null(value: Column) -> Column:
    """NaN means "not measured": NULL inside the engine."""
    return F.when(F.isnan(value), None).otherwise(value)


def stem(path: Column) -> Column:
    """File name without folders, up to its first dot."""
    return F.split_part(F.regexp_extract(path, r"([^/]*)$", 1), F.lit("."), F.lit(1))


#: Compartments and statistics of measurement keys.
COMPARTMENTS, STATISTICS = ("Nucleus", "Cytoplasm", "Cell"), ("Median", "Mean", "Sum")


def key_of(marker: Column, compartment: Column, statistic: Column) -> Column:
    """"marker: compartment: statistic"."""
    return F.concat(marker, F.lit(": "), compartment, F.lit(": "), statistic)


def measurement_key(key: Column) -> Column:
    """marker, compartment, statistic of "marker: compartment: statistic", known ones only; a bare marker has neither."""
    got = lambda i: F.regexp_extract(key, f"^(.+): ({'|'.join(COMPARTMENTS)}): ({'|'.join(STATISTICS)})$", i)
    part = lambda i: F.when(got(1) != "", got(i))
    return F.struct(F.coalesce(part(1), key).alias("marker"), part(2).alias("compartment"), part(3).alias("statistic"))


def parse_bytes(text: Column) -> Column:
    """Bytes of "3.2 GB" and the like, powers of 1024, to 1 place; a bare number is itself; "-", blanks and other units are NULL."""
    t = F.trim(text)
    number = F.regexp_extract(t, r"^([0-9.]+)\s*(?i:[KMGT]?B)$", 1).try_cast("double")
    unit = F.upper(F.regexp_extract(t, r"([A-Za-z]+)$", 1))
    power = F.when(unit == "B", 0).when(unit == "KB", 1).when(unit == "MB", 2).when(unit == "GB", 3).when(unit == "TB", 4)
    return F.coalesce(F.bround(number * F.pow(F.lit(1024.0), power), 1), t.try_cast("double"))


def tile_of(value: Column, size: float) -> Column:
    return F.floor(value / F.lit(size)).cast("long")


#: Seconds of a unit of time.
SECONDS = {"ms": 0.001, "s": 1.0, "m": 60.0, "h": 3600.0, "d": 86400.0}


def parse_duration(text: Column) -> Column:
    """Seconds of "1h 2m 3.5s" and the like; without a number and a known unit, the bare number, else NULL."""
    pattern = r"([0-9]+(?:\.[0-9]+)?)\s*(ms|s|m|h|d)"
    parts = lambda i: F.regexp_extract_all(text, F.lit(pattern), F.lit(i))
    unit = F.create_map(*[F.lit(v) for kv in SECONDS.items() for v in kv])
    each = F.zip_with(parts(1), parts(2), lambda n, u: n.cast("double") * unit[u])
    return F.when(F.size(each) > 0, F.aggregate(each, F.lit(0.0), lambda s, v: s + v)).otherwise(F.trim(text).try_cast("double"))


def parse_percent(text: Column) -> Column:
    """The number before a "%", or NULL where it isn't finite."""
    v = F.trim(F.rtrim(F.trim(text), F.lit("%"))).try_cast("double")
    return F.when(~F.isnan(v) & (F.abs(v) < float("inf")), v)


def packed_color(r: Column, g: Column, b: Column, a: Column) -> Column:
    """Signed 32-bit ARGB."""
    return F.shiftleft(a.cast("int"), 24).bitwiseOR(F.shiftleft(r.cast("int"), 16)).bitwiseOR(F.shiftleft(g.cast("int"), 8)).bitwiseOR(b.cast("int"))


def split_channels(raw: Column) -> Column:
    """Names between "|", trimmed, without blanks."""
    return F.filter(F.transform(F.split(raw, "[|]"), lambda x: F.trim(x)), lambda x: x != "")


def whole_or_null(text: Column) -> Column:
    """The whole part of a number; "-", blanks and other text are NULL."""
    return F.trim(text).try_cast("double").try_cast("long")


def float_or_null(text: Column) -> Column:
    """The number, NULL where it is NaN or no number."""
    return nan_to_null(F.trim(text).try_cast("double"))


def _shown(value: Column, text: Column) -> Column:
    """text, "N/A" where value is NULL, "n/a" where it isn't finite."""
    return F.when(value.isNull(), "N/A").when(F.isnan(value) | (F.abs(value) == float("inf")), "n/a").otherwise(text)


def shown_bytes(value: Column) -> Column:
    """"3.2 GB": one place and the largest unit below 1024 of the next, TB at most."""
    v = value.cast("double")
    of = lambda unit, power: F.format_string(f"%.1f {unit}", F.bround(v / 1024.0**power, 1))
    out = F.when(v < 1024.0, of("B", 0))
    for power, unit in enumerate(("KB", "MB", "GB"), 1):
        out = out.when(v < 1024.0 ** (power + 1), of(unit, power))
    return _shown(v, out.otherwise(of("TB", 4)))


def shown_seconds(value: Column) -> Column:
    """"1h 2m 3s" of whole seconds, without empty leading parts."""
    v = value.cast("double")
    s = v.try_cast("long")
    h, m, rest = F.floor(s / 3600), F.floor(s % 3600 / 60), s % 60
    return _shown(v, F.when(h > 0, F.format_string("%dh %dm %ds", h, m, rest)).when(m > 0, F.format_string("%dm %ds", m, rest)).otherwise(F.format_string("%ds", rest)))


def shown_pixels(value: Column) -> Column:
    """Two places and "px", "n/a" where there is no number."""
    return F.when(nan_to_null(value).isNull(), "n/a").otherwise(F.format_string("%.2f px", F.bround(value, 2)))


def short_process(name: Column) -> Column:
    """What is behind the last ":"."""
    return F.substring_index(F.coalesce(name, F.lit("")), ":", -1)


#: Micrometres of a unit of length.
MICROMETRES = {"µm": 1.0, "um": 1.0, "micron": 1.0, "nm": 0.001, "mm": 1000.0, "cm": 10000.0, "m": 1000000.0}


def unit_in_micrometres(unit: Column) -> Column:
    known = F.create_map(*[F.lit(v) for kv in MICROMETRES.items() for v in kv])
    return F.try_element_at(known, F.lower(F.trim(unit)))


def in_micrometres(value: Column, unit: Column) -> Column:
    """A positive length in micrometres; NULL for other numbers and unknown units."""
    v = value.try_cast("double")
    return F.when(v > 0, v * unit_in_micrometres(unit))


def pixel_size(configured: Column, detected: Column) -> Column:
    """The detected size where `auto` is configured, else the configured one; an error where neither is a positive number."""
    v = F.when(F.lower(F.trim(configured)) == "auto", detected).otherwise(configured.try_cast("double"))
    return F.when((v > 0) & (v < float("inf")), v).otherwise(F.raise_error(F.concat(F.lit("no pixel size: "), F.coalesce(configured, F.lit("")))).cast("double"))


def sizes_differ(a: Column, b: Column, rtol: float = 0.01) -> Column:
    """Whether two sizes are further apart than rtol of the second; false where either is missing."""
    return F.coalesce(F.abs(a - b) > rtol * F.abs(b), F.lit(False))


def centre_to_corner(value: Column) -> Column:
    """Centre-of-pixel coordinates as corner-of-pixel ones."""
    return value + 0.5


def stored(value: Column, low: float, high: float, kind: str) -> Column:
    """Rounded half to even and clamped to what a storage type holds."""
    return F.bround(F.least(F.greatest(value, F.lit(float(low))), F.lit(float(high)))).cast(kind)


def clipped(value: Column) -> Column:
    """Negative values as 0; NULL stays."""
    return F.when(value < 0, F.lit(0).cast("double")).otherwise(value)


def is_nuclear(channel: Column, markers: list[str]) -> Column:
    """Whether a channel's name holds any marker, whatever the case; blank and NULL names don't."""
    name = F.upper(F.trim(channel))
    return F.coalesce(F.greatest(*[F.contains(name, F.lit(m.strip().upper())) for m in [*markers, markers[0]]]) & (name != ""), F.lit(False))


def nuclear_index(channels: Column, markers: list[str]) -> Column:
    """Place (from 0) of the first channel with the first marker that any channel has; -1 without one."""
    names = F.transform(channels, lambda c: F.upper(F.trim(c)))
    has = lambda m: F.transform(names, lambda c: F.contains(c, F.lit(m.strip().upper())))
    first = [F.array_position(has(m), F.lit(True)) for m in markers]
    return F.coalesce(*[F.when(at > 0, at - 1) for at in first], F.lit(-1)).cast("int")


def markers_of(config: str | list[str]) -> list[str]:
    """Configured markers ("A,B" or a list) in upper case; an error without any."""
    got = [m.strip().upper() for m in (config.split(",") if isinstance(config, str) else config or []) if m and m.strip()]
    if not got:
        raise ValueError("no nuclear marker is configured")
    return got


def is_reference(value: Column) -> Column:
    """true or false in any case; an error for other text."""
    v = F.lower(F.trim(F.coalesce(value, F.lit(""))))
    return F.when(v == "true", True).when(v == "false", False).otherwise(F.raise_error(F.concat(F.lit("is_reference must be true or false, not "), v)).cast("boolean"))


def quoted(value: Column) -> Column:
    """A CSV field: in quotes, and quotes doubled, where it holds a comma, quote or line break; NULL is empty."""
    v = value.cast("string")
    return F.when(v.isNull(), "").when(v.rlike('[,"\n]'), F.concat(F.lit('"'), F.replace(v, F.lit('"'), F.lit('""')), F.lit('"'))).otherwise(v)


def published_path(outdir: Column, patient: Column, kind: Column, sub: Column, file: Column) -> Column:
    """outdir/patient/kind/sub/name of a file; no sub folder where sub is NULL."""
    return F.concat_ws("/", F.rtrim(outdir, F.lit("/")), patient, kind, sub, F.regexp_extract(file, r"([^/]*)$", 1))


def published_or_as_is(file: Column, task_dir: str, published: Column) -> Column:
    """The published path of a file in a task's folder; any other file's own path."""
    return F.when(F.startswith(file, F.lit(task_dir.rstrip("/") + "/")), published).otherwise(file)


def channel_color(index: Column) -> Column:
    """r, g, b (0 to 255) of a channel's place: hues a golden ratio apart."""
    i = index.cast("int")
    h6 = (i * 0.618033988749895) % 1.0 * 6
    s, v = 0.7 + (i % 3) * 0.1, 0.85 + (i % 2) * 0.1
    part = F.floor(h6).cast("int")
    f = h6 - part
    p, q, t = v * (1 - s), v * (1 - s * f), v * (1 - s * (1 - f))
    pick = lambda *six: F.floor(F.element_at(F.array(*six), part + 1) * 255).cast("int")
    return F.struct(pick(v, q, p, p, t, v).alias("r"), pick(t, v, v, q, p, p).alias("g"), pick(p, p, t, v, v, q).alias("b"))


#: Colours of known markers, by name.
MARKER_COLORS = {
    "DAPI": (0, 0, 255),
    "CD45": (0, 255, 0),
    "CD3": (255, 255, 0),
    "CD8": (255, 0, 255),
    "CD4": (0, 255, 255),
    "CD14": (255, 128, 0),
    "CD163": (255, 0, 128),
    "FOXP3": (128, 255, 0),
    "PANCK": (255, 0, 0),
    "VIMENTIN": (128, 0, 255),
    "SMA": (0, 128, 255),
    "GZMB": (255, 128, 128),
    "PD1": (128, 255, 128),
    "PDL1": (255, 200, 100),
    "L1CAM": (100, 200, 255),
    "PAX2": (200, 100, 255),
    "CD74": (255, 255, 128),
    "Segmentation": (255, 255, 255),
}


def marker_color(name: Column, index: Column) -> Column:
    """r, g, b of a known marker, whatever the case of its name, else of the channel's place."""
    known = F.create_map(*[x for k, v in MARKER_COLORS.items() for x in (F.lit(k.upper()), F.struct(*[F.lit(c).alias(n) for c, n in zip(v, "rgb", strict=True)]))])
    return F.coalesce(F.try_element_at(known, F.upper(name)), channel_color(index))


def checkpoint_path(outdir: Column, step: Column) -> Column:
    """outdir/csv/step.csv."""
    return F.concat(F.rtrim(outdir, F.lit("/")), F.lit("/csv/"), step, F.lit(".csv"))


def _clean(value: object) -> object:
    if isinstance(value, dict):
        return {k: _clean(v) for k, v in value.items()}
    if isinstance(value, list):
        return [_clean(v) for v in value]
    return float("nan") if value is None else value


def clean_document(text: Column) -> Column:
    """JSON text with nulls as NaN; NULL where it isn't JSON."""

    def one(t: str | None) -> str | None:
        try:
            return json.dumps(_clean(json.loads(t)))
        except (TypeError, ValueError):
            return None

    def column(texts: pd.Series) -> pd.Series:
        return texts.map(one)

    return F.pandas_udf(column, StringType())(text)


def channel_names(names: Column, n: Column) -> Column:
    """The names, or channel_0, channel_1, ... where there aren't n of them."""
    return F.when(F.size(names) == n, names).otherwise(F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.concat(F.lit("channel_"), i.cast("string"))))


def distance(ax: Column, ay: Column, bx: Column, by: Column) -> Column:
    return F.hypot(ax - bx, ay - by)


def bilinear_weights(value: Column, grid: Column) -> Column:
    """i0, i1 (places from 0) and t: where a value lies on an ascending grid, clamped to its ends."""
    n = F.size(grid)
    v = F.least(F.greatest(value, F.get(grid, F.lit(0))), F.get(grid, n - 1))
    i1 = F.least(F.greatest(F.size(F.filter(grid, lambda g: g <= v)), F.lit(1)), F.greatest(n - 1, F.lit(0)))
    i0 = F.greatest(i1 - 1, F.lit(0))
    span = F.get(grid, i1) - F.get(grid, i0)
    return F.struct(i0.alias("i0"), i1.alias("i1"), F.when(span > 0, (v - F.get(grid, i0)) / span).otherwise(0.0).alias("t"))


def downsample_factor(height: Column, width: Column, most: int) -> Column:
    """The least whole factor by which a plane's blocks are `most` at most; 1 where `most` is 0."""
    if not most:
        return F.lit(1)
    h, w = height.cast("long"), width.cast("long")
    low = F.greatest(F.floor(F.sqrt(F.floor(h * w / most))), F.lit(1)).cast("long")
    # A factor of (h / f + 1) * (w / f + 1) <= most is enough, and so is the longest side; blocks never grow with the factor, so halves lead to the least.
    enough = F.floor(((h + w) + F.sqrt((h + w).cast("double") * (h + w) + F.lit(4.0 * (most - 1)) * h * w)) / (2 * (most - 1))) + 1 if most > 1 else F.greatest(h, w)
    high = F.greatest(F.least(enough.cast("long"), F.greatest(h, w)), low)
    blocks = lambda f: F.ceil(h / f) * F.ceil(w / f)
    middle = lambda s: F.floor((s["low"] + s["high"]) / 2)
    halves = F.sequence(F.lit(0), F.ceil(F.log2(high - low + 1)).cast("int"))
    step = lambda s, _: F.when(blocks(middle(s)) <= most, F.struct(s["low"].alias("low"), middle(s).alias("high"))).otherwise(F.struct((middle(s) + 1).alias("low"), s["high"].alias("high")))
    once = lambda s, i: F.when(s["low"] < s["high"], step(s, i)).otherwise(s)
    least = F.aggregate(halves, F.struct(low.alias("low"), high.alias("high")), once)["high"]
    return F.when(h * w <= most, 1).otherwise(least.cast("int"))


def decimation_factor(longest: Column, most: int) -> Column:
    """The factor that brings the longest side under `most`; 1 where `most` is 0 or less."""
    return F.greatest(F.ceil(longest / most), F.lit(1)).cast("int") if most > 0 else F.lit(1)


def band_rows(width: Column, factor: int, size: int = 64 << 20) -> Column:
    """Rows of 4-byte pixels that fit a band's bytes, a multiple of factor and no less than it."""
    rows = F.greatest(F.floor(F.lit(size) / (F.greatest(width, F.lit(1)) * 4)), F.lit(factor))
    return F.greatest(F.floor(rows / factor) * factor, F.lit(factor)).cast("long")


def round_even(value: Column, places: int) -> Column:
    """A double to so many places: scaled, to the nearest whole, halves to the even one, and back.  What has no double when scaled stays as it is."""
    v, scale = value.cast("double"), F.lit(10.0**places)
    out = F.rint(v * scale) / scale
    return F.when(F.abs(out) == float("inf"), v).otherwise(out)


def number_text(value: Column) -> Column:
    """A double as JSON writers show it: plain from 0.0001 up to 1e16, where Spark has an exponent from 1e7 and below 0.001."""
    text, size = value.cast("string"), F.abs(value)
    places = F.regexp_replace(F.when((size >= 1e-4) & (size < 1e16), text).cast("decimal(38,21)").cast("string"), "0+$", "")
    plain = F.when(F.endswith(places, F.lit(".")), F.concat(places, F.lit("0"))).otherwise(places)
    power = F.regexp_extract(text, r"E(-?\d+)$", 1)
    sign, digits = F.when(F.startswith(power, F.lit("-")), "e-").otherwise("e+"), F.regexp_replace(power, "-", "")
    far = F.concat(F.regexp_extract(text, r"^(.*?)(?:\.0)?E", 1), sign, F.when(F.length(digits) < 2, "0").otherwise(""), digits)
    return F.when((size == 0) | ((size >= 1e-3) & (size < 1e7)), text).when((size >= 1e-4) & (size < 1e16), plain).otherwise(far)


def json_text(value: Column, kind: DataType) -> Column:
    """JSON of a column of this type as `to_json` has it, with NULL fields left out, but its doubles as `number_text`."""
    if isinstance(kind, StructType):
        fields = [F.concat(F.lit(json.dumps(f.name, ensure_ascii=False) + ":"), json_text(value[f.name], f.dataType)) for f in kind]
        return F.when(value.isNotNull(), F.concat(F.lit("{"), F.concat_ws(",", *fields), F.lit("}")))
    if isinstance(kind, ArrayType):
        return F.concat(F.lit("["), F.array_join(F.transform(value, lambda v: json_text(v, kind.elementType)), ",", "null"), F.lit("]"))
    quoted_ = F.to_json(F.array(value))
    other = F.when(value.isNotNull(), F.substr(quoted_, F.lit(2), F.length(quoted_) - 2))
    if isinstance(kind, DoubleType):
        return F.when(~F.isnan(value) & (F.abs(value) < float("inf")), number_text(value)).otherwise(other)
    return other
