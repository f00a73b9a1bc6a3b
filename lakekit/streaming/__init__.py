from lakekit.streaming.landing import land_raw_csv
from lakekit.streaming.maintenance import maintain_sales
from lakekit.streaming.refresh import stream_sales_by_category

__all__ = ["land_raw_csv", "maintain_sales", "stream_sales_by_category"]
