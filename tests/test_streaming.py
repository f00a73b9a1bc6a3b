import os

from lakekit.streaming import land_raw_csv


def _write(path, body):
    with open(path, "w") as f:
        f.write(body)


def test_each_delivery_lands_once(spark, tmp_dir):
    src, out, ckpt = (os.path.join(tmp_dir, n) for n in ("raw", "landed", "ckpt"))
    os.makedirs(src)
    _write(os.path.join(src, "a.csv"), 'product_id,price\n1,"10.5"\n2,3\n')
    land_raw_csv(spark, src, ["product_id", "price"], out, ckpt)
    assert spark.read.parquet(out).count() == 2
    # re-run with nothing new: no duplicates
    land_raw_csv(spark, src, ["product_id", "price"], out, ckpt)
    assert spark.read.parquet(out).count() == 2
    _write(os.path.join(src, "b.csv"), "product_id,price\n3,1\n")
    land_raw_csv(spark, src, ["product_id", "price"], out, ckpt)
    df = spark.read.parquet(out)
    assert df.count() == 3
    assert sorted(r.product_id for r in df.collect()) == ["1", "2", "3"]
    assert {os.path.basename(r._source_file) for r in df.select("_source_file").collect()} == {"a.csv", "b.csv"}


def test_landed_deliveries_feed_the_sales_job(spark, tmp_dir):
    from lakekit.plans.jobs import sales_by_category

    items_src, prod_src = os.path.join(tmp_dir, "items"), os.path.join(tmp_dir, "products")
    os.makedirs(items_src)
    os.makedirs(prod_src)
    _write(os.path.join(prod_src, "p.csv"), "product_id,product_category_name\np1,perfumaria\np2,pet_shop\n")
    _write(os.path.join(items_src, "day1.csv"), 'product_id,order_item_id,price\np1,1,"58.90"\n')
    items_out, prod_out = os.path.join(tmp_dir, "landed_items"), os.path.join(tmp_dir, "landed_products")
    cols_i, cols_p = ["product_id", "order_item_id", "price"], ["product_id", "product_category_name"]
    land_raw_csv(spark, prod_src, cols_p, prod_out, os.path.join(tmp_dir, "ck_p"))
    land_raw_csv(spark, items_src, cols_i, items_out, os.path.join(tmp_dir, "ck_i"))
    _write(os.path.join(items_src, "day2.csv"), "product_id,order_item_id,price\np2,1,10\np1,2,1.10\n")
    land_raw_csv(spark, items_src, cols_i, items_out, os.path.join(tmp_dir, "ck_i"))
    sales = sales_by_category(spark.read.parquet(items_out), spark.read.parquet(prod_out))
    got = {r.product_category_name: (r.total_receita, r.qtd_itens) for r in sales.collect()}
    assert got == {"perfumaria": (60.0, 2), "pet_shop": (10.0, 1)}


def test_incremental_sales_refresh_equals_full_refresh(spark, tmp_dir):
    from lakekit.contracts import SALES_CONTRACT
    from lakekit.plans.jobs import sales_by_category
    from lakekit.sources.files import read_current, read_raw_csv
    from lakekit.streaming import stream_sales_by_category

    src = os.path.join(tmp_dir, "items")
    os.makedirs(src)
    products = spark.createDataFrame(
        [("p1", "perfumaria"), ("p2", None), ("p3", "pet_shop")], "product_id string, product_category_name string"
    )
    loc, ckpt = os.path.join(tmp_dir, "sales"), os.path.join(tmp_dir, "ck")
    cols = ["product_id", "order_item_id", "price"]
    deliveries = [
        'product_id,order_item_id,price\np1,1,"58.90"\np2,1,1.05\np9,1,7\n',
        "product_id,order_item_id,price\np1,2,0.10\np3,1,abc\np2,2,\n",
    ]
    for i, body in enumerate(deliveries):
        _write(os.path.join(src, f"d{i}.csv"), body)
        stream_sales_by_category(spark, src, cols, products, loc, ckpt)
        full = sales_by_category(read_raw_csv(spark, src), products)
        cur = read_current(spark, SALES_CONTRACT, loc)
        assert sorted(cur.collect(), key=str) == sorted(full.collect(), key=str)
    got = {r.product_category_name: (r.total_receita, r.qtd_itens) for r in read_current(spark, SALES_CONTRACT, loc).collect()}
    assert got == {"perfumaria": (59.0, 2), None: (1.05, 2), "pet_shop": (None, 1)}
