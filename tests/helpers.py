"""Small builders for hand-made fixture rows (unit tests only)."""

import datetime as dt
import os
from decimal import Decimal

from pricelens.schema import ITEM, PAGE, SNAPSHOT

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
SF_SMALL = "/root/testdata/sf0.001"
UTC = dt.timezone.utc
T0 = dt.datetime(2024, 6, 1, 10, 0, tzinfo=UTC)


def snapshot(item_id="SKU-7", name="Desk Lamp", price="1849.50", original="2466.00", discount=25.0,
             brand="Lumo", category="Lighting", url="https://shop.example/SKU-7",
             rating=3.9, reviews=58, location="Quezon City", keyword="lamp", page=1,
             at=T0):
    return (item_id, name, Decimal(price), None if original is None else Decimal(original), discount,
            brand, category, url, rating, reviews, location, keyword, page, at)


def ten_records():
    """Ten different items, SKU-0 to SKU-9, captured a minute apart."""
    return [snapshot(item_id=f"SKU-{i}", name=f"Lamp no. {i}", price=f"{250 * (i + 2)}.25", original=None,
                     discount=None, url=f"https://shop.example/SKU-{i}", rating=None if i == 4 else 3.5,
                     reviews=7 * i, at=T0 + dt.timedelta(minutes=i)) for i in range(10)]


def snapshots_df(spark, rows):
    return spark.createDataFrame(rows, SNAPSHOT)


def item(**kw):
    return tuple(kw.get(f) for f in ITEM.names)


def page_doc(run_id, keyword, page, items, captured_at=T0, failed=False):
    mods = None if failed else (list(items),)
    return (run_id, keyword, page, captured_at, mods)


def pages_df(spark, docs):
    return spark.createDataFrame(docs, PAGE)
