"""The maintained sales table equals the full refresh after every call."""

import os
import random

from lakekit.contracts import SALES_CONTRACT
from lakekit.plans.jobs import sales_by_category
from lakekit.sources.files import read_current
from lakekit.streaming import maintain_sales
from lakekit.streaming import maintenance as M

ITEMS, CHANGES = ["product_id", "order_item_id", "price"], ["product_id", "product_category_name", "seq", "deleted"]


def _csv(path, columns, rows):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write("\n".join([",".join(columns), *(",".join("" if x is None else str(x) for x in r) for r in rows)]) + "\n")


def test_equals_full_refresh_after_updates_and_deletes(spark, tmp_dir, monkeypatch):
    monkeypatch.setattr(M, "COMPACT_EVERY", 2)
    rng = random.Random(9)
    categories = ["toys", "pets", "books", None]
    products, items, seq = {}, [], 0
    loc, ckpt = f"{tmp_dir}/sales", f"{tmp_dir}/ckpt"
    os.makedirs(f"{tmp_dir}/items")
    os.makedirs(f"{tmp_dir}/changes")
    for call in range(5):
        new = [(f"p{rng.randrange(12) if rng.random() < 0.6 else 0}", rng.choice([1, None]), rng.choice([10.5, 0.1, "abc", -3, None, 1e9])) for _ in range(40)]
        changes = []
        for _ in range(8 if call != 3 else 0):
            p, seq = f"p{rng.randrange(14)}", seq + 1
            changes.append((p, rng.choice(categories), seq, rng.choice(["true", "false", None, "false"])))
        changes += [(p, "late", 0, "false") for p in list(products)[:2]]
        rng.shuffle(changes)
        for p, category, number, deleted in sorted(changes, key=lambda c: c[2]):
            if number > products.get(p, (None, 0))[1]:
                products[p] = (None if deleted == "true" else (category,), number)
        if call == 4:
            new = []  # changes alone
        items += new
        _csv(f"{tmp_dir}/items/{call}.csv", ITEMS, new)
        _csv(f"{tmp_dir}/changes/{call}.csv", CHANGES, changes)
        maintain_sales(spark, f"{tmp_dir}/items", ITEMS, f"{tmp_dir}/changes", CHANGES, loc, ckpt)
        listed = spark.createDataFrame([(p, c[0]) for p, (c, _) in products.items() if c], "product_id string, product_category_name string")
        raw = spark.createDataFrame([tuple(None if x is None else str(x) for x in r) for r in items], "product_id string, order_item_id string, price string")
        want = sorted(map(tuple, sales_by_category(raw, listed).collect()), key=str)
        assert sorted(map(tuple, read_current(spark, SALES_CONTRACT, loc).collect()), key=str) == want and want
    # nothing new: nothing changes
    maintain_sales(spark, f"{tmp_dir}/items", ITEMS, f"{tmp_dir}/changes", CHANGES, loc, ckpt)
    assert sorted(map(tuple, read_current(spark, SALES_CONTRACT, loc).collect()), key=str) == want


def test_products_are_kept_as_tables_and_an_epoch_runs_again(spark, tmp_dir, monkeypatch):
    monkeypatch.setattr(M, "COMPACT_EVERY", 2)
    loc, ckpt = f"{tmp_dir}/sales", f"{tmp_dir}/ckpt"
    calls = [
        ([("p1", 1, 2.5), ("p2", 1, 1), ("p3", 1, "NaN")], [("p1", "toys", 0, "false"), ("p2", "toys", 1, ""), ("p3", "pets", 1, "false")]),
        ([("p1", 1, 4), ("p4", "", 7)], [("p2", "pets", 2, "false"), ("p3", "pets", 2, "true"), ("p1", "late", 0, "false"), ("p4", "books", -1, "false")]),
        ([("p3", 1, 3), ("p2", 1, 8)], [("p4", "books", 1, "false"), ("p1", "", 5, "false"), ("p2", "toys", 1, "false")]),
    ]
    wants = [
        [("pets", "nan", 1), ("toys", "3.5", 2)],
        [("pets", "1.0", 1), ("toys", "6.5", 2)],
        [("None", "6.5", 2), ("books", "7.0", 0), ("pets", "9.0", 2)],
    ]
    for call, ((items, changes), want) in enumerate(zip(calls, wants)):
        _csv(f"{tmp_dir}/items/{call}.csv", ITEMS, items)
        _csv(f"{tmp_dir}/changes/{call}.csv", CHANGES, changes)
        for again in range(2):
            if again:  # as after a driver lost before the epoch's end was noted
                os.remove(f"{ckpt}/commits/{call}")
                os.remove(f"{ckpt}/commits/.{call}.crc")
            maintain_sales(spark, f"{tmp_dir}/items", ITEMS, f"{tmp_dir}/changes", CHANGES, loc, ckpt)
            assert sorted((str(a), str(b), c) for a, b, c in read_current(spark, SALES_CONTRACT, loc).collect()) == want
        # no call into Python for each product: their rows are tables, and Spark holds no state
        assert not os.path.exists(f"{ckpt}/state")
        assert spark.read.parquet(f"{ckpt}/product-deltas/epoch={call}").count() == len({r[0] for r in items + changes})
    assert os.path.exists(f"{ckpt}/product-totals/epoch=2")
