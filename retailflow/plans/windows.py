"""Window results that need dimensions: orders by user and product, refunds by trademark and category."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from retailflow import schemas
from retailflow.functions.times import text_wall
from retailflow.operators.lookup import category_chain, dimension_join, sku_attributes
from retailflow.operators.windows import WINDOW, tumble_distinct


@dataclass(frozen=True)
class ProductDimensions:
    """Product dimension frames, each with a unique ``id``."""

    sku: DataFrame
    spu: DataFrame
    trademark: DataFrame
    category3: DataFrame
    category2: DataFrame
    category1: DataFrame

    def chain(self, df: DataFrame) -> DataFrame:
        return category_chain(df, self.trademark, self.category3, self.category2, self.category1)


def user_spu_order_window(
    details: DataFrame, dims: ProductDimensions, ts: str = "ts", user: str = "user_id",
    sku: str = "sku_id", order: str = "order_id", amount: str = "split_total_amount",
    width: str = WINDOW,
) -> DataFrame:
    """Distinct orders and amount by user, product, trademark and category; names are added afterwards."""
    keyed = sku_attributes(details, dims.sku, sku).withColumnRenamed(user, "userId")
    totals = tumble_distinct(
        keyed, ts, ["userId", "spuId", "trademarkId", "category3Id"], order, "orderCount",
        {amount: "orderAmount"}, width,
    )
    named = dims.chain(dimension_join(totals, dims.spu, "spuId", {"spu_name": "spuName"}))
    return named.select(*schemas.WINDOW_RESULTS["user_spu_order"])


def refund_window(
    refunds: DataFrame, dims: ProductDimensions, ts: str = "ts", user: str = "user_id",
    sku: str = "sku_id", order: str = "order_id", width: str = WINDOW,
) -> DataFrame:
    """Distinct refunded orders by user, trademark and category."""
    keyed = sku_attributes(refunds, dims.sku, sku).withColumnRenamed(user, "userId")
    totals = tumble_distinct(
        keyed, ts, ["userId", "trademarkId", "category3Id"], order, "refundCount", width=width
    )
    return dims.chain(totals).select(*schemas.WINDOW_RESULTS["refund"])


def cart_event_time(carts: DataFrame, name: str = "ts") -> DataFrame:
    """Event time of a cart row: its time of change, else of creation."""
    return carts.withColumn(name, text_wall(F.coalesce("operate_time", "create_time")))


def search_keywords(pages: DataFrame, page: str = "page", ts: str = "ts") -> DataFrame:
    """Search keywords of a page log: pages that came from the search page with a keyword item."""
    return pages.filter(
        (F.col(page)["last_page_id"] == "search") & (F.col(page)["item_type"] == "keyword")
        & F.col(page)["item"].isNotNull()
    ).select(F.col(page)["item"].alias("item"), ts)
