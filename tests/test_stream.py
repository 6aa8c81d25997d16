from martloom.plans.mart import Mart
from martloom.sources.tables import Warehouse
from martloom.streaming.fact_stream import file_stream, stream_fact
from tests import samples
from tests.test_mart import START


def test_streamed_fact_equals_batch_fact(spark, tmp_path, collect):
    mart = Mart(spark, samples.feeds(spark), START)
    items = mart.feeds["order_items"]
    folder, progress = str(tmp_path / "items"), str(tmp_path / "progress")
    warehouse = Warehouse(spark, str(tmp_path / "warehouse"))

    def run():
        stream = file_stream(spark, folder, items.schema, files_per_batch=1)
        stream_fact(stream, mart.item_batch_plan, warehouse, "fact_order_items", progress, first_batch=5)

    items.where("order_id < 'o3'").coalesce(1).write.mode("append").parquet(folder)
    run()
    # A later file brings the rest and repeats one order already loaded.
    items.where("order_id >= 'o3' or order_id = 'o1'").coalesce(1).write.mode("append").parquet(folder)
    run()
    run()
    got = warehouse.read("mart", "fact_order_items")
    assert collect(got.drop("load_batch")) == collect(mart.fact_order_items_plan())
    assert collect(got.select("load_batch").distinct()) == [(5,), (6,)]
