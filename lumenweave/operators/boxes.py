"""Box operators by picture: overlap join, greedy merge, containment tree, tree text, depth levels.

What order decides (greedy merge, first parent, text) runs in Python on one picture at a time, many pictures in a batch. A group is
one picture, so its size is bounded by what a picture holds; a placeholder path under which many pictures were filed must be
told apart by ``keys`` (for example path and record), which all operators take.

The segmenter and the depth model of a picture are not part of this package: masks default to the box itself, depths are a
column. Both can be supplied.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from ..functions import geometry as G
from ..functions.labels import format_labels, merge_labels, number_apart, types_of
from ..functions.nouns import plural

KEYS = ("image_path",)
#: Cells per side of the grid that keys the overlap join.
GRID = 4


def exploded(rows: DataFrame, keys: tuple[str, ...] = KEYS) -> DataFrame:
    """``(*keys, obj_id, label, x1, y1, x2, y2)`` of ``rows(*keys, bboxes)``; boxes without all coordinates are left out."""
    out = rows.select(*keys, F.posexplode("bboxes").alias("obj_id", "b")).select(*keys, "obj_id", "b.label", *[F.col(f"b.{c}").cast("double").alias(c) for c in ("x1", "y1", "x2", "y2")])
    return out.where("x1 is not null and y1 is not null and x2 is not null and y2 is not null")


def overlap_pairs(boxes: DataFrame, least: float, keys: tuple[str, ...] = KEYS) -> DataFrame:
    """``(*keys, a, b, iou)``: pairs of one picture's boxes, ``a < b`` by obj_id, with more than ``least`` overlap (0 or more).

    Boxes are keyed by the cells of a grid that they touch; a pair is taken in the cell of the lower corner of its common part
    alone, so it comes once, and boxes far apart never meet. Coordinates are shares of the picture.
    """
    joined = _meeting(boxes, "a", "b", keys).where("a < b")
    return joined.withColumn("iou", G.iou(F.col("a_box"), F.col("b_box"))).where(F.col("iou") > least).select(*keys, "a", "b", "iou")


def _meeting(boxes: DataFrame, one: str, two: str, keys: tuple[str, ...], more: dict[str, Column] | None = None) -> DataFrame:
    """Every two boxes of a picture that share a cell, each pair once: obj_ids ``one`` and ``two``, ``_box``, and ``more`` columns."""
    cell = lambda c: F.least(F.greatest(F.floor(F.col(c) * GRID), F.lit(0)), F.lit(GRID - 1)).cast("int")
    spread = boxes.withColumn("cx", F.explode(F.sequence(cell("x1"), F.greatest(cell("x1"), cell("x2"))))).withColumn("cy", F.explode(F.sequence(cell("y1"), F.greatest(cell("y1"), cell("y2")))))
    side = lambda n: spread.select(*keys, "cx", "cy", F.col("obj_id").alias(n), F.struct("x1", "y1", "x2", "y2").alias(f"{n}_box"), *[c.alias(f"{n}_{k}") for k, c in (more or {}).items()])
    joined = side(one).join(side(two), [*keys, "cx", "cy"])
    a, b = F.col(f"{one}_box"), F.col(f"{two}_box")
    at = lambda c: F.least(F.greatest(F.floor(F.greatest(a[c], b[c]) * GRID), F.lit(0)), F.lit(GRID - 1))
    return joined.where((at("x1") == F.col("cx")) & (at("y1") == F.col("cy"))).drop("cx", "cy")


# Greedy merge


def box_iou(a: list[float], b: list[float]) -> float:
    width, height = min(a[2], b[2]) - max(a[0], b[0]), min(a[3], b[3]) - max(a[1], b[1])
    common = max(width, 0.0) * max(height, 0.0)
    both = max(a[2] - a[0], 0) * max(a[3] - a[1], 0) + max(b[2] - b[0], 0) * max(b[3] - b[1], 0) - common
    return common / both if both > 0 else 0.0


@dataclass
class Cluster:
    box: list[float]
    labels: list[str]
    members: list[int]
    mask: np.ndarray | None = None


def greedy_clusters(boxes: list[list[float]] | np.ndarray, labels: list[list[str]], least: float, masks: list[np.ndarray] | None = None, apart: Callable[[list[str], list[str]], bool] | None = None) -> list[Cluster]:
    """Boxes in their order, each joined to the first cluster whose grown box overlaps it by more than ``least``.

    With masks these must overlap as much, and masks of a cluster are united; ``apart`` keeps labels from one cluster.
    """
    clusters: list[Cluster] = []
    for i, box in enumerate(boxes.tolist() if isinstance(boxes, np.ndarray) else boxes):
        for c in clusters:
            if box_iou(c.box, box) <= least or apart and apart(c.labels, labels[i]):
                continue
            if masks is not None and mask_iou(c.mask, masks[i]) <= least:
                continue
            c.box = [min(c.box[0], box[0]), min(c.box[1], box[1]), max(c.box[2], box[2]), max(c.box[3], box[3])]
            c.labels += labels[i]
            c.members.append(i)
            if masks is not None:
                c.mask = c.mask | masks[i]
            break
        else:
            clusters.append(Cluster(list(box), list(labels[i]), [i], None if masks is None else masks[i].copy()))
    return clusters


def mask_iou(a: np.ndarray, b: np.ndarray) -> float:
    both = np.logical_or(a, b).sum()
    return float(np.logical_and(a, b).sum() / both) if both else 0.0


def by_picture(objects: DataFrame, keys: tuple[str, ...], columns: tuple[str, ...], work: Callable[[list[dict]], list[tuple]], schema: str) -> DataFrame:
    """``(*keys, schema)``: rows that ``work`` makes of one picture's objects in the order of obj_id.

    The objects of a picture become one array and pictures go to Python by the batch, which costs far less than a frame each.
    """
    listed = objects.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("obj_id", *columns))).alias("_objects"))
    kinds = ", ".join(f"{k} {objects.schema[k].dataType.simpleString()}" for k in keys)
    names = [f.strip().split(" ")[0] for f in schema.split(",")]

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = [batch.column(k).to_pylist() for k in range(len(keys))]
            rows = [(*key, *row) for *key, items in zip(*own, batch.column(len(keys)).to_pylist()) for row in work(items)]
            columns = list(zip(*rows)) if rows else [[] for _ in out]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, out)], names=[*keys, *names])

    out = [f.type for f in to_arrow_schema(T._parse_datatype_string(f"{kinds}, {schema}"))]
    return listed.mapInArrow(each, f"{kinds}, {schema}")


def merge_boxes(boxes: DataFrame, least: float = 0.9, keys: tuple[str, ...] = KEYS, layout: str = "xyxy") -> DataFrame:
    """``(*keys, obj_id, label, x1, y1, x2, y2, n)``: merged boxes of ``boxes(*keys, obj_id, label, x1..y2)``, in input order.

    ``layout`` ``xywh`` reads the last two numbers as width and height. Labels of a cluster are merged and formatted; null
    labels count as empty.
    """
    def merge(items: list[dict]) -> list[tuple]:
        corners = [[o["x1"], o["y1"], o["x2"], o["y2"]] for o in items]
        if layout == "xywh":
            corners = [[x, y, x + w, y + h] for x, y, w, h in corners]
        clusters = greedy_clusters(corners, [[o["label"] or ""] for o in items], least)
        return [(k, format_labels(merge_labels(c.labels)), *c.box, len(c.members)) for k, c in enumerate(clusters)]

    return by_picture(boxes, keys, ("label", "x1", "y1", "x2", "y2"), merge, "obj_id int, label string, x1 double, y1 double, x2 double, y2 double, n int")


def unpack_mask(mask: bytes, width: int) -> np.ndarray:
    """A mask from its packed bits, row by row; ``width`` pixels each, padding at the end."""
    bits = np.unpackbits(np.frombuffer(mask, dtype=np.uint8))
    return bits[: len(bits) // width * width].reshape(-1, width).astype(bool)


def box_mask(box: np.ndarray, height: int, width: int) -> np.ndarray:
    """The box itself as a mask, where no segmenter gave one."""
    out = np.zeros((height, width), dtype=bool)
    x1, y1, x2, y2 = (round(v) for v in np.array(box) * [width, height, width, height])
    out[y1 : max(y2, y1 + 1), x1 : max(x2, x1 + 1)] = True
    return out


def merge_masked(boxes: DataFrame, least: float = 0.6, keys: tuple[str, ...] = KEYS) -> DataFrame:
    """Merged boxes of ``boxes(*keys, obj_id, label, x1..y2, mask, mask_width)`` whose boxes and masks both overlap by more.

    Singular and plural of a label stay apart; masks of a cluster are united. Returns ``(*keys, obj_id, label, x1..y2, n,
    mask, mask_share, center_x, center_y)``: the united mask, its share of the picture and the medians of its pixels.
    """
    def merge(items: list[dict]) -> list[tuple]:
        masks = [unpack_mask(o["mask"], o["mask_width"]) for o in items]
        clusters = greedy_clusters([[o["x1"], o["y1"], o["x2"], o["y2"]] for o in items], [[o["label"] or ""] for o in items], least, masks, number_apart)
        rows = []
        for k, c in enumerate(clusters):
            ys, xs = np.nonzero(c.mask)
            height, width = c.mask.shape
            center = (float(np.median(xs) / width), float(np.median(ys) / height)) if len(xs) else ((c.box[0] + c.box[2]) / 2, (c.box[1] + c.box[3]) / 2)
            rows.append((k, format_labels(merge_labels(c.labels)), *c.box, len(c.members), np.packbits(c.mask).tobytes(), float(c.mask.mean()), *center))
        return rows

    some = boxes.where("mask is not null and mask_width > 0")
    return by_picture(some, keys, ("label", "x1", "y1", "x2", "y2", "mask", "mask_width"), merge, "obj_id int, label string, x1 double, y1 double, x2 double, y2 double, n int, mask binary, mask_share double, center_x double, center_y double")


# Containment


def containment_pairs(objects: DataFrame, least: float = 0.2, grace: int = 1, keys: tuple[str, ...] = KEYS) -> DataFrame:
    """``(*keys, inner, outer)`` of ``objects(*keys, obj_id, label, x1..y2, depth_low, depth_high)``.

    One object lies in another if more than ``least`` of it does, its box is smaller, its first label is another one, and their
    depths, each wider by ``grace`` on both sides, meet. Objects without depths lie in none, so their tree is flat.
    """
    more = {"label": F.split("label", r" \(")[0], "low": F.col("depth_low"), "high": F.col("depth_high")}
    joined = _meeting(objects.where("x1 is not null and y1 is not null and x2 is not null and y2 is not null"), "inner", "outer", keys, more).where(F.col("inner") != F.col("outer"))
    i, j = F.col("inner_box"), F.col("outer_box")
    other = ~F.col("inner_label").eqNullSafe(F.col("outer_label"))
    deep = G.ranges_overlap(F.col("inner_low"), F.col("inner_high"), F.col("outer_low"), F.col("outer_high"), grace)
    return joined.where(other & deep & (G.area(i) < G.area(j)) & (G.contained(i, j) > least)).select(*keys, "inner", "outer")


@dataclass
class Node:
    """An object: box, share of the picture that it covers, depths from 0 (near), and what lies in it."""

    label: str
    box: list[float]
    size: float
    depths: list[int] = field(default_factory=list)
    children: list[Node] = field(default_factory=list)

    def depth_range(self) -> tuple[int, int] | None:
        return (min(self.depths), max(self.depths)) if self.depths else None

    def center(self) -> tuple[float, float]:
        return (self.box[0] + self.box[2]) / 2, 1 - (self.box[1] + self.box[3]) / 2


def _meet(a: Node, b: Node, grace: int) -> bool:
    x, y = a.depth_range(), b.depth_range()
    return x is not None and y is not None and x[0] - grace <= y[1] + grace and y[0] - grace <= x[1] + grace


def _share_inside(a: list[float], b: list[float]) -> float:
    size = max(a[2] - a[0], 0) * max(a[3] - a[1], 0)
    common = max(min(a[2], b[2]) - max(a[0], b[0]), 0) * max(min(a[3], b[3]) - max(a[1], b[1]), 0)
    return common / size if size > 0 else 0.0


def build_tree(nodes: list[Node], least: float = 0.2, grace: int = 1) -> list[Node]:
    """Roots of the tree: objects in no other one. Walked by index, a node belongs to the first parent that reaches it."""
    size = [max(n.box[2] - n.box[0], 0) * max(n.box[3] - n.box[1], 0) for n in nodes]
    first = [n.label.split(" (")[0] for n in nodes]
    inside = [[j for j in range(len(nodes)) if first[i] != first[j] and size[i] < size[j] and _meet(nodes[i], nodes[j], grace) and _share_inside(nodes[i].box, nodes[j].box) > least] for i in range(len(nodes))]
    seen: set[int] = set()

    def visit(j: int) -> Node:
        seen.add(j)
        for i in range(len(nodes)):
            if j in inside[i] and i not in seen:
                nodes[j].children.append(visit(i))
        return nodes[j]

    return [visit(j) for j in range(len(nodes)) if not inside[j]]


def _step(value: float, step: float = 0.05) -> float:
    return round(value / step) * step


def _corners(box: list[float]) -> str:
    return "[" + ", ".join(f"{_step(v):.2f}" for v in box) + "] "


def node_text(n: Node, boxes: bool = True, corners: bool = False) -> str:
    """An object's label with centre, size in per cent and depths (``boxes``), and before them its corners (``corners``)."""
    if not boxes:
        return n.label
    x, y = n.center()
    depths = f", Relative Depths: {', '.join(map(str, n.depths))}" if n.depths else ""
    return f"{n.label} {_corners(n.box) if corners else ''}[X: {_step(x):.2f}, Y: {_step(y):.2f}, Pixel Size: {_step(n.size * 100):.1f}%{depths}]"


# Kinds of which no number is told, and the largest number that is.
NO_NUMBER, MOST_TOLD = ("window", "drink", "tree", "building"), 8


def shown_count(labels: list[str], kind: str) -> str:
    """How many objects of a kind there are: ``many`` beyond eight; ``several`` if a label has the kind's plural or it isn't counted."""
    if len(labels) > MOST_TOLD:
        return "many"
    many = plural(kind)
    return "several" if any(many in label for label in labels) or any(k in kind for k in NO_NUMBER) else str(len(labels))


def _averages(nodes: list[Node], corners: bool = False) -> str:
    x, y = (sum(v) / len(nodes) for v in zip(*(n.center() for n in nodes)))
    region = _corners([f(n.box[i] for n in nodes) for i, f in enumerate((min, min, max, max))]) if corners else ""
    return f"{region}[Average X: {_step(x):.2f}, Average Y: {_step(y):.2f}, Average Pixel Size: {sum(n.size for n in nodes) / len(nodes) * 100:.1f}%]"


def _near(a: Node, b: Node, most: float) -> bool:
    (ax, ay), (bx, by) = a.center(), b.center()
    return abs(ax - bx) <= most and abs(ay - by) <= most


def _level_text(nodes: list[Node], level: int, most: float, boxes: bool = True, corners: bool = False) -> str:
    indent = "    " * level + ("-> " if level else "")
    order = sorted(nodes, key=lambda n: (-n.size, sum(n.depths) / len(n.depths) if n.depths else 0))
    kinds: dict[str, list[Node]] = {}
    done: set[int] = set()
    for n in order:
        for kind in types_of(n.label):
            kinds.setdefault(kind, []).append(n)
    blocks = []
    for kind, own in kinds.items():
        own = [n for n in own if id(n) not in done]
        done |= {id(n) for n in own}
        groups: list[list[Node]] = []
        for n in own:
            home = next((g for g in groups if all(_meet(n, m, 0) and _near(n, m, most) for m in g)), None)
            groups.append([n]) if home is None else home.append(n)
        for group in groups:
            if len(group) == 1:
                blocks.append(_single(group[0], indent, most, boxes, corners))
            elif not any(n.children for n in group):
                blocks.append(f"{indent}{shown_count([n.label for n in group], kind)} ({plural(kind)}) {_averages(group, corners)}")
            else:
                inner = "\n".join(_single(n, indent + "    ", most, boxes, corners) for n in group)
                blocks.append(f"{indent}{shown_count([n.label for n in group], kind)} ({plural(kind)}) {{\n{inner}\n{indent}}}")
    return "\n\n".join(blocks)


def _single(n: Node, indent: str, most: float, boxes: bool = True, corners: bool = False) -> str:
    if not n.children:
        return f"{indent}{node_text(n, boxes, corners)} X"
    return f"{indent}{node_text(n, boxes, corners)}, with:\n{_level_text(n.children, len(indent.split('->')[0]) // 4 + 1, most, boxes, corners)}"


def count_types(nodes: list[Node]) -> Counter:
    """Objects of each type in the whole tree."""
    out: Counter = Counter()
    for n in nodes:
        out.update(types_of(n.label))
        out += count_types(n.children)
    return out


def tree_text(roots: list[Node], most: float = 2.0, boxes: bool = True, corners: bool = False) -> str:
    """The tree as text, and the counts of its types. Empty for no objects. ``boxes`` and ``corners``: see :func:`node_text`."""
    if not roots:
        return ""
    counts = "\n".join(f"\t{plural(k)}: {n}" for k, n in count_types(roots).items())
    return f"{_level_text(roots, 0, most, boxes, corners)}\n\nObject Counts:\n{counts}"


def box_trees(objects: DataFrame, keys: tuple[str, ...] = KEYS, first: float = 0.95, second: float = 0.6, inside: float = 0.2, near: float = 2.0, with_boxes: bool = True, with_corners: bool = False) -> DataFrame:
    """``(*keys, n_objects, n_roots, text)`` of ``objects(*keys, obj_id, label, x1..y2, depths array<int>)``.

    Boxes are merged twice, the second time not across singular and plural; the tree is built from what is left. ``depths``
    may be null.
    """
    def text(items: list[dict]) -> list[tuple]:
        depths = [o["depths"] or [] for o in items]
        once = greedy_clusters([[o["x1"], o["y1"], o["x2"], o["y2"]] for o in items], [[o["label"] or ""] for o in items], first)
        twice = greedy_clusters([c.box for c in once], [merge_labels(c.labels) for c in once], second, apart=number_apart)
        nodes = []
        for c in twice:
            own = sorted({d for k in c.members for i in once[k].members for d in depths[i]})
            nodes.append(Node(format_labels(merge_labels(c.labels)), c.box, max(c.box[2] - c.box[0], 0) * max(c.box[3] - c.box[1], 0), own))
        roots = build_tree(nodes, inside)
        return [(len(nodes), len(roots), tree_text(roots, near, with_boxes, with_corners))]

    return by_picture(objects, keys, ("label", "x1", "y1", "x2", "y2", "depths"), text, "n_objects int, n_roots int, text string")


def type_counts(objects: DataFrame, keys: tuple[str, ...] = KEYS) -> DataFrame:
    """``(*keys, type, n)``: objects of each type in a picture's tree, of ``objects(*keys, obj_id, label)``. Null labels have no type."""

    def count(items: list[dict]) -> list[tuple]:
        return sorted(count_types([Node(o["label"], [0.0] * 4, 0.0) for o in items]).items())

    return by_picture(objects.where("label is not null"), keys, ("label",), count, "type string, n int")


def group_averages(objects: DataFrame, keys: tuple[str, ...] = KEYS) -> DataFrame:
    """``(*keys, type, n, text)``: number and average text of the objects of each type of a picture, of ``objects(*keys, obj_id, label, x1..y2)``."""

    def averages(items: list[dict]) -> list[tuple]:
        groups: dict[str, list[Node]] = {}
        for o in items:
            box = [o[c] for c in ("x1", "y1", "x2", "y2")]
            for kind in types_of(o["label"]):
                groups.setdefault(kind, []).append(Node(o["label"], box, max(box[2] - box[0], 0) * max(box[3] - box[1], 0)))
        return [(kind, len(nodes), _averages(nodes, True)) for kind, nodes in sorted(groups.items())]

    return by_picture(objects.where("label is not null"), keys, ("label", "x1", "y1", "x2", "y2"), averages, "type string, n int, text string")


# Depths


def depth_cuts(depth: np.ndarray, bins: int = 50, least_prominence: float = 0.002, least_height: float = 0.001, ratio: float = 1.6, most: int = 15) -> tuple[np.ndarray, int] | None:
    """Values between the peaks of a depth map's histogram, and the number of groups they part; None with fewer than two peaks.

    Peaks need a share of the histogram's sum; the most prominent are kept, and while more than two are left the one that
    stands out least against its larger neighbouring valley is dropped if it does so by no more than ``ratio``.
    """
    counts, edges = np.histogram(depth, bins=bins)
    middle = np.median(counts)
    h = np.r_[0.0, counts / middle if middle else counts.astype(float)]
    peaks = [i for i in range(1, len(h)) if h[i] > h[i - 1] and h[i] >= (h[i + 1] if i + 1 < len(h) else -1) and h[i] > least_height * h.sum()]

    def prominence(i: int) -> float:
        left = h[:i][::-1]
        right = h[i + 1 :]
        walls = [next((k for k, v in enumerate(side) if v > h[i]), len(side)) for side in (left, right)]
        lows = [side[:w].min() if w else h[i] for side, w in zip((left, right), walls)]
        return float(h[i] - max(lows))

    kept = sorted((i for i in peaks if prominence(i) >= least_prominence * h.sum()), key=lambda i: -prominence(i))[:most]
    kept.sort()
    if len(kept) < 2:
        return None
    while len(kept) > 2:
        valleys = [h[a : b + 1].min() for a, b in zip(kept, kept[1:])]
        stands = [h[p] / max(max([*valleys[max(k - 1, 0) : k], *valleys[k : k + 1]]), 1e-9) for k, p in enumerate(kept)]
        worst = int(np.argmin(stands))
        if stands[worst] > ratio:
            break
        kept.pop(worst)
    cuts = np.array([edges[max((a + b) // 2 - 1, 0)] for a, b in zip(kept, kept[1:])])
    return cuts, len(kept)


def object_depths(depth: np.ndarray, mask: np.ndarray, cuts: tuple[np.ndarray, int] | None) -> list[int]:
    """Depth levels in a mask, from 0 (near), without the outer 15 per cent of its values on either side."""
    if cuts is None or not mask.any():
        return []
    groups = np.searchsorted(cuts[0], depth[mask], side="left")
    low, high = np.percentile(groups, [15, 85])
    return sorted({int(cuts[1] - 1 - g) for g in np.unique(np.clip(groups, round(low), round(high)))})


def with_depths(objects: DataFrame, maps: DataFrame, keys: tuple[str, ...] = KEYS) -> DataFrame:
    """``objects(*keys, obj_id, x1..y2, ...)`` with ``depths``, levels from 0 (near), by ``maps(*keys, depth array<int>, depth_width)``.

    An object's mask is its ``mask`` (packed bits of ``mask_width`` pixels a row, as large as the map) if there is one, else its
    box. An object without a map, or of one without two groups of depths, has no levels. The objects of a picture become one
    row before the join, so a map is moved once and its groups are found once.
    """
    masked = {"mask", "mask_width"} <= set(objects.columns)
    columns = ("x1", "y1", "x2", "y2", *(("mask", "mask_width") if masked else ()))
    listed = objects.groupBy(*keys).agg(F.collect_list(F.struct("obj_id", *columns)).alias("_objects"))
    one = maps.dropDuplicates(list(keys)).where("depth_width > 0 and size(depth) >= depth_width").select(*keys, "depth", "depth_width")
    kinds = ", ".join(f"{k} {objects.schema[k].dataType.simpleString()}" for k in keys)
    out = [f.type for f in to_arrow_schema(T._parse_datatype_string(f"{kinds}, obj_id int, depths array<int>"))]

    def mask_of(o: dict, height: int, width: int) -> np.ndarray:
        if masked and o["mask"] is not None and o["mask_width"]:
            mask = unpack_mask(o["mask"], o["mask_width"])[:height, :width]
            if mask.shape == (height, width):
                return mask
        return box_mask([o[c] for c in ("x1", "y1", "x2", "y2")], height, width)

    def levels(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple] = []
            *own, listed_objects, maps_of, widths = (batch.column(i) for i in range(len(keys) + 3))
            for i, width in enumerate(widths.to_pylist()):
                values = maps_of[i].values.to_numpy(zero_copy_only=False)
                depth = values[: len(values) // width * width].reshape(-1, width)
                cuts = depth_cuts(depth)
                key = [k[i].as_py() for k in own]
                rows += [(*key, o["obj_id"], object_depths(depth, mask_of(o, *depth.shape), cuts)) for o in listed_objects[i].as_py()]
            columns = list(zip(*rows)) if rows else [[] for _ in out]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, out)], names=[*keys, "obj_id", "depths"])

    found = listed.join(one, list(keys)).mapInArrow(levels, f"{kinds}, obj_id int, depths array<int>")
    return objects.join(found, [*keys, "obj_id"], "left").withColumn("depths", F.coalesce("depths", F.array().cast("array<int>")))
