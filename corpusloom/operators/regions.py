"""Merging of regions that cover the same pixels, unless their labels contradict."""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import DataFrame

from corpusloom.functions.nested import canonical, merged
from corpusloom.functions.raster import mask_iou

#: From this overlap on regions are one, and are looked at.
DUPLICATE_IOU, REVIEW_IOU = 0.98, 0.80
RESULT = "image_id long, region_id string, root string, labels string, review array<string>"


def merge_regions(regions: DataFrame) -> DataFrame:
    """(image_id, region_id, root, labels, review) of regions (image_id, region_id, polygon
    as pairs, labels as JSON text, width, height).

    Of an image's pairs, those of most overlap first: duplicates merge with all that is
    merged with either, if no label of the two sides contradicts; else both get a code for
    review, as pairs of partial overlap do. root is the least region of what is merged. An
    image's regions are few, and go to one task together."""

    def merge(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("region_id").reset_index(drop=True)
        shapes = [[tuple(p) for p in poly] for poly in rows["polygon"]]
        labels = [json.loads(t) for t in rows["labels"]]
        root, review = list(range(len(rows))), [set() for _ in shapes]
        box = [(min(x for x, _ in s), min(y for _, y in s), max(x for x, _ in s), max(y for _, y in s)) for s in shapes]
        edges = []
        for i in range(len(rows)):
            for j in range(i + 1, len(rows)):
                a, b = box[i], box[j]
                if a[0] <= b[2] and b[0] <= a[2] and a[1] <= b[3] and b[1] <= a[3]:
                    iou = mask_iou(shapes[i], shapes[j], int(rows["width"][i]), int(rows["height"][i]))
                    if iou >= REVIEW_IOU:
                        edges.append((-iou, i, j))

        def find(i: int) -> int:
            while root[i] != i:
                i = root[i]
            return i

        for iou, i, j in sorted(edges):
            a, b = sorted((find(i), find(j)))
            if -iou < DUPLICATE_IOU:
                code = "C_partial_overlap_0.80_to_0.98"
            elif a == b:
                continue
            else:
                both, conflicts = merged(labels[a], labels[b])
                if not conflicts:
                    root[b], labels[a] = a, both
                    continue
                code = "label_conflict_prevents_auto_merge"
            for k in (i, j):
                review[k].add(code)
        tops = [find(i) for i in range(len(rows))]
        return pd.DataFrame({"image_id": rows["image_id"], "region_id": rows["region_id"], "root": [rows["region_id"][t] for t in tops], "labels": [canonical(labels[t]) for t in tops], "review": [sorted(r) for r in review]})

    return regions.groupBy("image_id").applyInPandas(merge, RESULT)
