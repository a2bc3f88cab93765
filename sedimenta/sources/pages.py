"""The shape of one page of a paged JSON API, and pages written as files."""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class PageError(ValueError):
    """A page, or the pages of a task together, aren't what they announce."""


@dataclass(frozen=True)
class Body:
    page: int | None
    size: int | None
    total: int
    rows: int


def parse_page(text: str) -> Body:
    """Announced place, page size and total of a page, and the items it holds (an array, one object or none)."""
    try:
        response = json.loads(text)["response"]
        body = response["body"]
        code = response.get("header", {}).get("resultCode", "00")
        total, size, page = int(body["totalCount"]), body.get("numOfRows"), body.get("pageNo")
        size, page = None if size is None else int(size), None if page is None else int(page)
    except (ValueError, KeyError, TypeError, AttributeError) as error:
        raise PageError(f"not a page: {text[:80]!r}") from error
    if str(code).strip("0"):
        raise PageError(f"the source answered {code}")
    if total < 0:
        raise PageError("a negative total")
    items = body.get("items")
    items = items.get("item") if isinstance(items, dict) else items
    if items in (None, ""):
        rows = 0
    elif isinstance(items, list):
        rows = len(items)
    elif isinstance(items, dict):
        rows = 1
    else:
        raise PageError("items are neither an array nor an object")
    return Body(page, size, total, rows)


def paged(rows: DataFrame, task: list[str], order: str, item: Column, size: int) -> DataFrame:
    """(task..., page, body): rows as the pages of an API, `size` items a page in the given order within each task.

    Pages are numbered per task by how many items come before; the totals are those of the task.
    """
    from pyspark.sql import Window

    by = Window.partitionBy(*task)
    placed = rows.select(*task, F.to_json(item).alias("_item"), F.row_number().over(by.orderBy(order)).alias("_at"), F.count("*").over(by).alias("_total"))
    pages = placed.groupBy(*task, F.ceil(F.col("_at") / size).cast("int").alias("page"), "_total").agg(F.array_sort(F.collect_list(F.struct("_at", "_item"))).alias("_items"))
    items = F.concat(F.lit("["), F.array_join(F.col("_items._item"), ","), F.lit("]"))
    head = F.concat(F.lit('{"response":{"header":{"resultCode":"00"},"body":{"pageNo":'), F.col("page").cast("string"), F.lit(f',"numOfRows":{size},"totalCount":'), F.col("_total").cast("string"))
    return pages.select(*task, "page", F.concat(head, F.lit(',"items":{"item":'), items, F.lit("}}}}")).alias("body"))


def land_pages(pages: DataFrame, root: str) -> None:
    """Write (three task columns, page, body) as <root>/<a>/<b>/<c>/page-<n>.json, each task's pages where their partition is."""

    def write(rows) -> None:
        from pyarrow import fs

        store, base = fs.FileSystem.from_uri(root) if "://" in root or root.startswith("file:") else (fs.LocalFileSystem(), root)
        made = set()
        for a, b, c, page, body in rows:
            folder = f"{base.rstrip('/')}/{a}/{b}/{c}"
            if folder not in made:
                store.create_dir(folder, recursive=True)
                made.add(folder)
            with store.open_output_stream(f"{folder}/page-{page}.json") as out:
                out.write(body.encode("utf-8"))

    pages.foreachPartition(write)
