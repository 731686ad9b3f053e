"""Conversation records, choices, COCO documents and manifests."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def conversation(df: DataFrame, key: str, order: str, role: str, text: str) -> DataFrame:
    """(key, n_turns, transcript): the turns of each key in order, as role: text lines."""
    turns = F.array_sort(F.collect_list(F.struct(order, F.concat(F.col(role), F.lit(": "), F.col(text)).alias("line"))))
    return df.groupBy(key).agg(turns.alias("t")).select(key, F.size("t").cast("long").alias("n_turns"), F.array_join(F.transform("t", lambda x: x["line"]), "\n").alias("transcript"))


def coco_rows(df: DataFrame, image: str, polygon: Column, box: Column) -> DataFrame:
    """COCO annotations: flat segmentation and x, y, width, height."""
    flat = F.flatten(F.transform(polygon, lambda p: F.array(p["x"], p["y"])))
    return df.select(image, flat.alias("segmentation"), F.array(box[0], box[1], box[2] - box[0], box[3] - box[1]).alias("bbox"))


def manifest_hash(df: DataFrame, *columns: str) -> DataFrame:
    """One row: the SHA-256 over all rows in order, one line each. For small tables."""
    line = F.concat_ws("\u0000", *(F.col(c).cast("string") for c in columns))
    return df.agg(F.sha2(F.array_join(F.array_sort(F.collect_list(line)), "\n"), 256).alias("sha256"), F.count(F.lit(1)).alias("n"))


def coco_document(images: list[dict], annotations: list[dict], categories: list[str]) -> dict:
    """One COCO document of a split's images and annotations, which a caller has bounded
    (one for each split and part): categories are numbered from 1, in the order given."""
    number = {c: i for i, c in enumerate(categories, 1)}
    rows = [{"id": i, "image_id": a["image_id"], "category_id": number[a["category"]], "segmentation": [a["segmentation"]], "bbox": a["bbox"], "area": a["area"], "iscrowd": 0} for i, a in enumerate(annotations, 1)]
    return {"info": {}, "licenses": [], "categories": [{"id": i, "name": c} for c, i in number.items()], "images": images, "annotations": rows}
