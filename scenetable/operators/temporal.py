"""Temporal checks of image sequences: flow validity, directed pairs and triplets of frames, gates that fail closed."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import PART_ROWS, by_sort, checkpointed

COLOURS = ("r", "g", "b")
#: The thresholds of the checks.
THRESHOLDS = {
    "core_valid_fraction": 0.70, "control_valid_fraction": 0.80, "region_pixels": 4096, "control_colour_p95": 20.0, "core_colour_p95": 24.0, "core_excess_p95": 8.0,
    "core_gradient_p95": 32.0, "bad_pixel": 24.0, "bad_pixel_fraction": 0.10, "triplet_valid_fraction": 0.50, "triplet_difference_p95": 20.0, "triplet_excess_p95": 6.0,
}
_AT = ["src", "dst", "y", "x"]


def gather(at: DataFrame, images: DataFrame, on: dict[str, str], values: list[str]) -> DataFrame:
    """`at` (src, dst, y, x, tx, ty, w, h) with `values` of the images read bilinearly at (tx, ty), held to the image: src, dst, y, x and values.

    `on` names the columns of `at` and of the images (y, x, values, ...) that must agree. A place is up to four rows, joined by
    equal keys and summed; null where a corner is missing.
    """
    x, y = F.greatest(F.lit(0.0), F.least(F.col("w") - 1.0, F.col("tx"))), F.greatest(F.lit(0.0), F.least(F.col("h") - 1.0, F.col("ty")))
    rows = at.select(*_AT, *(c for c in on if c not in _AT), "w", "h", x.alias("_x"), y.alias("_y")).withColumns({"_fx": F.col("_x") - F.floor("_x"), "_fy": F.col("_y") - F.floor("_y")})
    corner = lambda i, j: F.struct((F.floor("_y") + j).cast("int").alias("y"), (F.floor("_x") + i).cast("int").alias("x"), ((F.col("_fx") if i else 1 - F.col("_fx")) * (F.col("_fy") if j else 1 - F.col("_fy"))).alias("k"))
    rows = rows.withColumn("_c", F.explode(F.filter(F.array(*(corner(i, j) for j in (0, 1) for i in (0, 1))), lambda c: c["k"] > 0)))
    other = images.select(*(F.col(c).alias(f"_on{i}") for i, c in enumerate(on.values())), F.col("y").alias("_py"), F.col("x").alias("_px"), *(F.col(v).alias(f"_{v}") for v in values))
    same = [F.col(a) == F.col(f"_on{i}") for i, a in enumerate(on)] + [F.col("_c.y") == F.col("_py"), F.col("_c.x") == F.col("_px")]
    joined = rows.join(by_sort(other), same, "left")
    whole = F.count(f"_{values[0]}") == F.count("*")
    return joined.groupBy(*_AT).agg(*(F.when(whole, F.sum(F.col("_c.k") * F.col(f"_{v}"))).alias(v) for v in values))


#: Numpy types of packed columns: places, flows, colours.
_PLACE = {"y": "<i4", "x": "<i4"}
_FLOW, _IMAGE = _PLACE | {"dx": "<f8", "dy": "<f8"}, _PLACE | dict.fromkeys(COLOURS, "<f8")
_FIXED = _IMAGE | {f"fixed_{c}": "<f8" for c in COLOURS}
#: Rows that are packed together.
PACKED_ROWS = 1 << 18


def packed(rows: DataFrame, keys: list[str], kinds: dict[str, str]) -> DataFrame:
    """Pixels of equal keys as one row: keys, n, blob (their columns one after the other, bytes by place, compressed).

    Pixels are shuffled so, as rows of their own take many times the bytes. A task packs what it has of a key among PACKED_ROWS rows, so
    that few blobs come of images whose pixels lie together. Rows with a null key or place are left out.
    """

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            held.append(batch)
            n += batch.num_rows
            if n >= PACKED_ROWS:
                yield blobs(held)
                held, n = [], 0
        if n:
            yield blobs(held)

    def blobs(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(held)
        table = table.take(pc.sort_indices(table, sort_keys=[(k, "ascending") for k in keys])).combine_chunks()
        new = np.zeros(len(table), bool)
        new[0] = True
        for k in keys:
            new[1:] |= pc.not_equal(table[k][1:], table[k][:-1]).to_numpy()
        heads = np.flatnonzero(new)
        stops = [*heads[1:], len(table)]
        columns = [table[c].to_numpy().astype(kind) for c, kind in kinds.items()]
        out = [pa.compress(b"".join(c[i:j].view(np.uint8).reshape(j - i, -1).T.tobytes() for c in columns), codec="zstd", asbytes=True) for i, j in zip(heads, stops, strict=True)]
        first = table.select(keys).take(pa.array(heads)).combine_chunks()
        return pa.RecordBatch.from_arrays([*(first[k].chunk(0) for k in keys), pa.array(stops - heads, pa.int32()), pa.array(out, pa.binary())], names=[*keys, "n", "blob"])

    types = dict(rows.dtypes)
    whole = rows.where(" AND ".join(f"{c} IS NOT NULL" for c in [*keys, "y", "x"]))
    cast = {"<i4": "int", "<f8": "double"}
    return whole.select(*keys, *(F.col(c).cast(cast[k]).alias(c) for c, k in kinds.items())).mapInArrow(pack, ", ".join(f"{k} {types[k]}" for k in keys) + ", n int, blob binary")


def _unpacked(n: int, blob: bytes, kinds: dict[str, str]) -> list[np.ndarray]:
    sizes = [np.dtype(k).itemsize for k in kinds.values()]
    raw = np.frombuffer(pa.decompress(blob, n * sum(sizes), codec="zstd"), np.uint8)
    stops = np.cumsum(sizes)
    return [np.ascontiguousarray(raw[(b - s) * n : b * n].reshape(s, n).T).view(k).ravel() for s, b, k in zip(sizes, stops, kinds.values(), strict=True)]


class _Pixels:
    """Values by place, found by equal places."""

    def __init__(self, blobs: list[tuple[int, bytes]], kinds: dict[str, str]):
        self.y, self.x, *values = (np.concatenate(c) for c in zip(*(_unpacked(n, b, kinds) for n, b in blobs), strict=True))
        self.values = np.stack(values, 1) if values else np.zeros((len(self.y), 0))
        keys = self.key(self.y, self.x)
        self.order = np.argsort(keys, kind="stable")
        self.keys = keys[self.order]

    @staticmethod
    def key(y: np.ndarray, x: np.ndarray) -> np.ndarray:
        return (y.astype(np.int64) << 32) + x.astype(np.int64)

    def find(self, y: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where each place is, and whether it is there."""
        key = self.key(y, x)
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return self.order[at], self.keys[at] == key

    def read(self, values: np.ndarray, tx: np.ndarray, ty: np.ndarray, w: int, h: int) -> np.ndarray:
        """`values` of the places read bilinearly at (tx, ty), held to the image; NaN where a corner is missing."""
        x, y = np.fmax(0.0, np.fmin(w - 1.0, tx)), np.fmax(0.0, np.fmin(h - 1.0, ty))
        left, top = np.floor(x), np.floor(y)
        out = np.zeros((len(x), values.shape[1]))
        for j in (0, 1):
            for i in (0, 1):
                k = (x - left if i else 1 - (x - left)) * (y - top if j else 1 - (y - top))
                at, there = self.find(top + j, left + i)
                out += np.where((k > 0)[:, None], k[:, None] * np.where(there[:, None], values[at], np.nan), 0.0)
        return out


def _by_pair(steps: DataFrame, regions: DataFrame, sizes: DataFrame, images: DataFrame | None = None):
    """What is known of two frames, grouped: packed flows both ways (`steps`), regions, sizes and images of both. A group holds two images."""
    two = steps.withColumns({"lo": F.least("src", "dst"), "hi": F.greatest("src", "dst")})
    near = by_sort(two.select("lo", "hi").distinct().withColumn("frame_id", F.explode(F.array_distinct(F.array("lo", "hi")))))
    of = lambda rows, kind: rows.join(near, "frame_id").withColumnRenamed("frame_id", "src").withColumn("kind", F.lit(kind))
    rows = two.withColumn("kind", F.lit("flow")).unionByName(of(packed(regions, ["frame_id", "region"], _PLACE), "region"), True).unionByName(of(sizes.select("frame_id", F.col("w").cast("int").alias("w"), F.col("h").cast("int").alias("h")), "size"), True)
    if images is not None:
        rows = rows.unionByName(of(packed(images, ["frame_id"], _IMAGE), "image"), True)
    pixels = steps.agg(F.sum("n")).first()[0] or 0
    return rows.repartition(max(steps.sparkSession.sparkContext.defaultParallelism, -(-pixels // PART_ROWS)), "lo", "hi").groupBy("lo", "hi")


def _held(rows: pa.Table) -> tuple[dict, dict, dict, dict]:
    """Of a group of `_by_pair`: flows by (src, dst), regions by frame and name, sizes and images by frame."""
    flows, regions, sizes, images = {}, {}, {}, {}
    for r in rows.to_pylist():
        blob = (r["n"], r["blob"])
        if r["kind"] == "flow":
            flows.setdefault((r["src"], r["dst"]), []).append(blob)
        elif r["kind"] == "region":
            regions.setdefault(r["src"], {}).setdefault(r["region"], []).append(blob)
        elif r["kind"] == "size":
            sizes[r["src"]] = (r["w"], r["h"])
        else:
            images.setdefault(r["src"], []).append(blob)
    flows = {k: _Pixels(v, _FLOW) for k, v in flows.items()}
    regions = {f: {name: _Pixels(v, _PLACE) for name, v in of.items()} for f, of in regions.items()}
    return flows, regions, sizes, {k: _Pixels(v, _IMAGE) for k, v in images.items()}


def _followed(flows: dict, regions: dict, sizes: dict, absolute: float, relative: float) -> Iterator[tuple]:
    """The pixels of each region of each directed pair: (src, dst, region), their columns."""
    for (src, dst), flow in flows.items():
        for name, region in regions.get(src, {}).items() if src in sizes else ():
            at, there = flow.find(region.y, region.x)
            y, x, (dx, dy), (w, h) = region.y[there], region.x[there], flow.values[at[there]].T, sizes[src]
            if not len(y):
                continue
            tx, ty = x + dx, y + dy
            back = flows.get((dst, src))
            bx, by = back.read(back.values, tx, ty, w, h).T if back else np.full((2, len(y)), np.nan)
            error = np.sqrt((dx + bx) ** 2 + (dy + by) ** 2)
            inside = (tx >= 0) & (tx <= w - 1) & (ty >= 0) & (ty <= h - 1)
            consistent = inside & (error <= absolute + relative * np.sqrt(dx * dx + dy * dy))
            other = regions.get(dst, {}).get(name)
            overlap = inside & other.find(np.fmax(0, np.fmin(h - 1, np.rint(ty))), np.fmax(0, np.fmin(w - 1, np.rint(tx))))[1] if other else np.zeros(len(y), bool)
            yield (src, dst, name), {"y": y, "x": x, "tx": tx, "ty": ty, "w": np.full(len(y), w), "h": np.full(len(y), h), "fb_error": error, "consistent": consistent, "overlap": overlap, "valid": consistent & overlap}


def _table(schema: pa.Schema, parts: list[tuple[dict, dict]]) -> pa.Table:
    """Parts (values that are the same in each row, arrays) as one table."""
    rows = []
    for fixed, columns in parts:
        n = len(columns["y"])
        rows.append(pa.table([pa.repeat(pa.scalar(fixed[f.name], f.type), n) if f.name in fixed else pa.array(columns[f.name], f.type, from_pandas=True) for f in schema], schema))
    return pa.concat_tables(rows) if rows else schema.empty_table()


def _schema(text: str) -> pa.Schema:
    kinds = {"int": pa.int32(), "bigint": pa.int64(), "long": pa.int64(), "smallint": pa.int16(), "tinyint": pa.int8(), "string": pa.string(), "double": pa.float64(), "boolean": pa.bool_()}
    return pa.schema([(name, kinds[kind]) for name, kind in (part.split() for part in text.split(", "))])


def flow_validity(flow: DataFrame, regions: DataFrame, sizes: DataFrame, absolute: float = 1.5, relative: float = 0.01) -> DataFrame:
    """Which pixels of each frame's core and control ring can be followed to another frame.

    flow: src, dst, y, x, dx, dy, both ways; regions: frame_id, y, x, region (core or control); sizes: frame_id, w, h. A
    pixel is consistent if it stays in the image and the flow back from there, read bilinearly, misses it by at most
    absolute + relative * flow length; overlapping if the nearest target pixel is of the same region; valid if both. Returns src, dst, y, x,
    region, tx, ty, w, h, fb_error, consistent, overlap, valid.
    """
    kinds = dict(flow.dtypes)
    text = f"src {kinds['src']}, dst {kinds['dst']}, y int, x int, region string, tx double, ty double, w int, h int, fb_error double, consistent boolean, overlap boolean, valid boolean"
    schema = _schema(text)

    def judged(rows: pa.Table) -> pa.Table:
        flows, regions, sizes, _ = _held(rows)
        return _table(schema, [(dict(zip(("src", "dst", "region"), key, strict=True)), columns) for key, columns in _followed(flows, regions, sizes, absolute, relative)])

    return _by_pair(_steps(flow), regions, sizes).applyInArrow(judged, text)


def _steps(flow: DataFrame) -> DataFrame:
    return checkpointed(packed(flow.where("dx IS NOT NULL AND dy IS NOT NULL"), ["src", "dst"], _FLOW))


def pair_coverage(validity: DataFrame) -> DataFrame:
    """Counts and shares of each directed pair (src, dst) by region: pixels, overlap, consistent, valid, and the 95th percentile of valid pixels' errors."""
    out = []
    for region in ("core", "control"):
        here = F.col("region") == region
        out.append(F.count_if(here).alias(f"{region}_pixels"))
        out += [F.count_if(here & F.col(c)).alias(f"{region}_{c}") for c in ("overlap", "consistent", "valid")]
        out.append(F.percentile(F.when(here & F.col("valid"), F.col("fb_error")), 0.95).alias(f"{region}_fb_p95"))
    return _shares(validity.groupBy("src", "dst").agg(*out))


def _shares(rows: DataFrame) -> DataFrame:
    share = lambda a, b: F.when(F.col(b) > 0, F.col(a) / F.col(b))
    return rows.withColumns({f"{r}_{c}_fraction": share(f"{r}_{c}", f"{r}_pixels") for r in ("core", "control") for c in ("overlap", "consistent", "valid")})


def _slopes(image: _Pixels) -> np.ndarray:
    """The length of the Sobel gradient (over 8) of each colour at each pixel; the next pixels of its row and column count, at an end itself."""

    def beside(values: np.ndarray, line: np.ndarray, along: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        order = np.lexsort((along, line))
        same = line[order][1:] == line[order][:-1]
        before, after = values.copy(), values.copy()
        before[order[1:][same]], after[order[:-1][same]] = values[order[:-1][same]], values[order[1:][same]]
        return before, after

    before, after = beside(image.values, image.y, image.x)
    d, s = after - before, before + 2 * image.values + after
    above, below = beside(np.concatenate([d, s], 1), image.x, image.y)
    across, down = (above[:, :3] + 2 * d + below[:, :3]) / 8, (below[:, 3:] - above[:, 3:]) / 8
    return np.sqrt(across * across + down * down)


def colour_gradient(images: DataFrame) -> DataFrame:
    """The length of the Sobel gradient (over 8) of each colour of dense images, edges repeated: frame_id, y, x, r, g, b. A task holds one image."""
    text = f"frame_id {dict(images.dtypes)['frame_id']}, y int, x int, r double, g double, b double"
    schema = _schema(text)

    def bent(rows: pa.Table) -> pa.Table:
        image = _Pixels(list(zip(rows["n"].to_pylist(), rows["blob"].to_pylist(), strict=True)), _IMAGE)
        return _table(schema, [({"frame_id": rows["frame_id"][0].as_py()}, {"y": image.y, "x": image.x} | dict(zip(COLOURS, _slopes(image).T, strict=True)))])

    return packed(images, ["frame_id"], _IMAGE).groupBy("frame_id").applyInArrow(bent, text)


def robust_affine(x: np.ndarray, y: np.ndarray, rounds: int = 8) -> tuple[float, float] | str:
    """Gain and offset that take x to y, by least squares reweighted after Huber (1.345 of 1.4826 MAD), or why there are none."""
    if len(x) < 2:
        return "fewer than two samples"
    if np.quantile(x, 0.95) - np.quantile(x, 0.05) < 2.0:
        return "exposure fit is ill-conditioned"
    weight, a, b = np.ones(len(x)), 1.0, 0.0
    for _ in range(rounds):
        w = weight.sum()
        mx, my = (weight * x).sum() / w, (weight * y).sum() / w
        spread = (weight * (x - mx) ** 2).sum()
        if spread <= 1e-12 * w:
            return "exposure fit is ill-conditioned"
        a = float((weight * (x - mx) * (y - my)).sum() / spread)
        b = float(my - a * mx)
        left = y - a * x - b
        middle = np.median(left)
        cut = 1.345 * 1.4826 * np.median(np.abs(left - middle))
        if cut <= 1.345e-6:
            break
        weight = np.minimum(1.0, cut / np.maximum(np.abs(left - middle), 1e-300))
    if not (0.5 <= a <= 2.0 and -128.0 <= b <= 128.0):
        return "exposure fit is outside plausible bounds"
    return a, b


def _p95(values: np.ndarray) -> float | None:
    return float(np.quantile(values, 0.95)) if len(values) else None


def _mean(values: np.ndarray) -> float | None:
    return float(values.mean()) if len(values) else None


def _known(values: np.ndarray) -> np.ndarray:
    return values[~np.isnan(values)]


def _compared(rows: pa.Table, t: dict[str, float]) -> Iterator[tuple[dict, dict[str, dict]]]:
    """Each directed pair of a group of `_by_pair`: its counts, measures and reason; its valid pixels by region, corrected, if it has an exposure."""
    flows, regions, sizes, images = _held(rows)
    pairs: dict[tuple, dict[str, dict]] = {}
    for (src, dst, name), columns in _followed(flows, regions, sizes, 1.5, 0.01):
        pairs.setdefault((src, dst), {})[name] = columns
    slopes = {frame: _slopes(image) for frame, image in images.items()}
    for (src, dst), parts in pairs.items():
        out = {"src": src, "dst": dst}
        for r in ("core", "control"):
            c = parts.get(r, {"y": [], "overlap": np.zeros(0, bool), "consistent": np.zeros(0, bool), "valid": np.zeros(0, bool), "fb_error": np.zeros(0)})
            out |= {f"{r}_pixels": len(c["y"]), **{f"{r}_{k}": int(c[k].sum()) for k in ("overlap", "consistent", "valid")}, f"{r}_fb_p95": _p95(c["fb_error"][c["valid"]])}
        if not out["core_pixels"] or not out["control_pixels"]:
            out["reason"] = "a region is empty"
        else:
            out["reason"] = next((f"too few valid {r} pixels" for r in ("core", "control") if out[f"{r}_valid"] < t["region_pixels"]), None)
        seen = {}
        for name, c in parts.items() if not out["reason"] and src in images and dst in images else ():
            w, h = sizes[src]
            y, x, tx, ty = (c[k][c["valid"]] for k in ("y", "x", "tx", "ty"))
            at, there = images[src].find(y, x)
            at, y, x, tx, ty = at[there], y[there], x[there], tx[there], ty[there]
            seen[name] = {"y": y, "x": x, "own": images[src].values[at], "steep": slopes[src][at], "warped": images[dst].read(images[dst].values, tx, ty, w, h), "bent": images[dst].read(slopes[dst], tx, ty, w, h)}
        ring = seen.get("control")
        if not out["reason"] and ring is not None and len(ring["y"]):
            found = [robust_affine(ring["warped"][:, k], ring["own"][:, k]) for k in range(len(COLOURS))]
            out["reason"] = next((f for f in found if isinstance(f, str)), None)
            if not out["reason"]:
                gain, offset = np.array(found).T
                for s in seen.values():
                    s["fixed"] = s["warped"] * gain + offset
                    s["colour"], s["slope"] = np.abs(s["own"] - s["fixed"]).sum(1) / 3, np.abs(s["steep"] - s["bent"] * np.abs(gain)).sum(1) / 3
        fixed = {name: s for name, s in seen.items() if "fixed" in s}
        for r in ("core", "control"):
            if r in fixed:
                colour, slope = _known(fixed[r]["colour"]), _known(fixed[r]["slope"])
                out |= {f"{r}_colour_mean": _mean(colour), f"{r}_colour_p95": _p95(colour)}
                if r == "core":
                    out |= {"core_gradient_mean": _mean(slope), "core_gradient_p95": _p95(slope), "bad_pixel_fraction": _mean((colour > t["bad_pixel"]).astype(float))}
        yield out, fixed


def _gates(gates: list[tuple[str, Column]]) -> Column:
    """The names of the gates that do not hold; one that cannot be told does not."""
    return F.filter(F.array(*(F.when(~F.coalesce(ok, F.lit(False)), name) for name, ok in gates)), lambda g: g.isNotNull())


def temporal_pairs(flow: DataFrame, regions: DataFrame, sizes: DataFrame, images: DataFrame, limits: dict[str, float] | None = None) -> tuple[DataFrame, DataFrame]:
    """How each frame's core changes to another frame, against its control ring, with the exposure corrected.

    images: frame_id, y, x, r, g, b, dense. The valid pixels' colours and gradients are read in the other frame; a gain and
    offset by colour from the control ring correct them. Returns one row a directed pair: the columns of `pair_coverage`, colour and
    gradient measures, evaluable, reason, failed_gates, passed; and the valid pixels with corrected colours, for `temporal_triplets`.
    Both are found anew where they are read, by tasks that hold two images at a time; only packed flows are written.
    A pair with an empty region, fewer valid pixels than region_pixels, or no plausible exposure is not evaluable and does not pass.
    """
    t = THRESHOLDS | (limits or {})
    kinds = dict(flow.dtypes)
    key = f"src {kinds['src']}, dst {kinds['dst']}"
    groups = _by_pair(_steps(flow), regions, sizes, images)
    counts = [f"{r}_{c} {kind}" for r in ("core", "control") for c, kind in (("pixels", "long"), ("overlap", "long"), ("consistent", "long"), ("valid", "long"), ("fb_p95", "double"))]
    measures = ["control_colour_mean", "control_colour_p95", "core_colour_mean", "core_colour_p95", "core_gradient_mean", "core_gradient_p95", "bad_pixel_fraction"]
    summary = ", ".join([key, *counts, "reason string", *(f"{m} double" for m in measures)])
    single = ", ".join([key, "y int, x int, region string", *(f"{c} double" for c in (*COLOURS, *(f"fixed_{c}" for c in COLOURS), "colour", "slope"))])
    summary_schema, single_schema = _schema(summary), _schema(single)

    def judged(rows: pa.Table) -> pa.Table:
        return pa.Table.from_pylist([{f.name: out.get(f.name) for f in summary_schema} for out, _ in _compared(rows, t)], summary_schema)

    def fixed(rows: pa.Table) -> pa.Table:
        columns = lambda s: {k: s[k] for k in ("y", "x", "colour", "slope")} | {c: s["own"][:, k] for k, c in enumerate(COLOURS)} | {f"fixed_{c}": s["fixed"][:, k] for k, c in enumerate(COLOURS)}
        return _table(single_schema, [({"src": out["src"], "dst": out["dst"], "region": name}, columns(s)) for out, parts in _compared(rows, t) for name, s in parts.items()])

    corrected = groups.applyInArrow(fixed, single)
    rows = _shares(groups.applyInArrow(judged, summary))
    rows = rows.select("src", "dst", *(c.split()[0] for c in counts), *(c for c in rows.columns if c.endswith("_fraction") and c != "bad_pixel_fraction"), "reason", *measures)
    rows = rows.withColumn("core_excess_p95", F.col("core_colour_p95") - F.col("control_colour_p95")).withColumn("evaluable", F.col("reason").isNull())
    gates = [(f"{r}_valid_fraction", F.col(f"{r}_valid_fraction") >= t[f"{r}_valid_fraction"]) for r in ("core", "control")]
    gates += [(c, F.col(c) <= t[c]) for c in ("control_colour_p95", "core_colour_p95", "core_excess_p95", "core_gradient_p95", "bad_pixel_fraction")]
    rows = rows.withColumn("failed_gates", F.when(F.col("evaluable"), _gates(gates)))
    return rows.withColumn("passed", F.col("evaluable") & (F.size("failed_gates") == 0)), corrected


def _second_differences(schema: pa.Schema) -> Callable[[pa.Table], pa.Table]:
    """Of a triplet's packed pixels: how many are valid on both sides by region, and how far the corrected ones lie from their mean."""

    def found(rows: pa.Table) -> pa.Table:
        held: dict[tuple, list] = {}
        for r in rows.to_pylist():
            held.setdefault((r["kind"], r["_d"], r["region"]), []).append((r["n"], r["blob"]))
        out = {k: rows[k][0].as_py() for k in ("previous", "centre", "following")}
        for r in ("core", "control"):
            of = lambda kind, side, r=r: _Pixels(held[kind, out[side], r], _PLACE if kind == "valid" else _FIXED) if (kind, out[side], r) in held else None
            p, n = of("valid", "previous"), of("valid", "following")
            both = n.find(p.y, p.x)[1] if p and n else np.zeros(0, bool)
            out |= {f"{r}_valid": int(both.sum()), f"{r}_mean": None, f"{r}_difference_p95": None}
            a, b = of("fixed", "previous"), of("fixed", "following")
            if both.any() and a and b:
                y, x = p.y[both], p.x[both]
                (i, here), (j, there) = a.find(y, x), b.find(y, x)
                i, j = i[here & there], j[here & there]
                off = _known(np.abs(a.values[i, :3] - (a.values[i, 3:] + b.values[j, 3:]) / 2).sum(1) / 3)
                out |= {f"{r}_mean": _mean(off), f"{r}_difference_p95": _p95(off)}
        return pa.Table.from_pylist([out], schema)

    return found


def temporal_triplets(triplets: DataFrame, pixels: DataFrame, regions: DataFrame, validity: DataFrame, limits: dict[str, float] | None = None) -> DataFrame:
    """How far the centre of each triplet (previous, centre, following) lies from the mean of its neighbours, both warped and corrected.

    `pixels` and `validity` are of the pairs centre to previous and centre to following (`temporal_pairs`, `flow_validity`). Only pixels
    valid in both count. Returns one row a triplet: pixels and valid shares, second-difference measures, evaluable, reason, failed_gates, passed;
    a triplet with too few valid pixels or without both exposures is not evaluable and does not pass.
    """
    t = THRESHOLDS | (limits or {})
    whole = regions.groupBy(F.col("frame_id").alias("centre")).agg(*(F.count_if(F.col("region") == r).alias(f"{r}_pixels") for r in ("core", "control")))
    parts = max(regions.sparkSession.sparkContext.defaultParallelism, -(-4 * regions.count() // PART_ROWS))
    blobs = packed(validity.where("valid"), ["src", "dst", "region"], _PLACE).withColumn("kind", F.lit("valid")).union(packed(pixels, ["src", "dst", "region"], _FIXED).withColumn("kind", F.lit("fixed")))
    blobs = blobs.withColumnsRenamed({"src": "centre", "dst": "_d"}).repartition(parts, "centre")
    mine = blobs.join(by_sort(triplets.select("previous", "centre", "following").distinct().withColumnRenamed("centre", "_c")), (F.col("centre") == F.col("_c")) & ((F.col("_d") == F.col("previous")) | (F.col("_d") == F.col("following")))).drop("_c")
    kinds = dict(triplets.dtypes) | {"centre": dict(blobs.dtypes)["centre"]}
    text = ", ".join([f"previous {kinds['previous']}, centre {kinds['centre']}, following {kinds['following']}, core_valid long, control_valid long", *(f"{r}_{n} double" for r in ("core", "control") for n in ("mean", "difference_p95"))])
    found = mine.groupBy("previous", "centre", "following").applyInArrow(_second_differences(_schema(text)), text)
    count = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    rows = triplets.join(by_sort(whole), "centre", "left").join(by_sort(found), ["previous", "centre", "following"], "left")
    rows = rows.select("previous", "centre", "following", *(count(f"{r}_{c}") for r in ("core", "control") for c in ("pixels", "valid")), *(f"{r}_{c}" for r in ("core", "control") for c in ("mean", "difference_p95")))
    rows = rows.withColumns({f"{r}_valid_fraction": F.when(F.col(f"{r}_pixels") > 0, F.col(f"{r}_valid") / F.col(f"{r}_pixels")).otherwise(0.0) for r in ("core", "control")} | {"excess_p95": F.col("core_difference_p95") - F.col("control_difference_p95")})
    reason = F.when(F.col("core_valid") < t["region_pixels"], "too few valid core pixels").when(F.col("control_valid") < t["region_pixels"], "too few valid control pixels").when(F.col("core_mean").isNull() | F.col("control_mean").isNull(), "an exposure fit is missing")
    rows = rows.withColumn("reason", reason).withColumn("evaluable", F.col("reason").isNull())
    gates = [("triplet_valid_fraction", F.col("core_valid_fraction") >= t["triplet_valid_fraction"]), ("triplet_difference_p95", F.col("core_difference_p95") <= t["triplet_difference_p95"]), ("triplet_excess_p95", F.col("excess_p95") <= t["triplet_excess_p95"])]
    rows = rows.withColumn("failed_gates", F.when(F.col("evaluable"), _gates(gates)))
    return rows.withColumn("passed", F.col("evaluable") & (F.size("failed_gates") == 0))
