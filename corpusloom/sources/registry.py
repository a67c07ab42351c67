"""Sources, their feeds and sitemaps, and their categories."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The names of the feeds of each source, under its address.
FEEDS = {
    "https://tuoitre.vn/rss/": "tin-moi-nhat thoi-su the-gioi kinh-doanh cong-nghe xe van-hoa giai-tri the-thao phap-luat giao-duc suc-khoe du-lich gia-that khoa-hoc",
    "https://nhandan.vn/rss/": (
        "home chinhtri-1171 xa-luan-1176 kinhte-1185 chungkhoan-1191 vanhoa-1251 xahoi-1211 phapluat-1287 du-lich-1257 thegioi-1231 thethao-1224 giaoduc-1303 y-te-1309 "
        "khoahoc-congnghe-1292 moi-truong-1296"
    ),
    "https://thanhnien.vn/rss/": "home thoi-su chinh-tri the-gioi kinh-te doi-song suc-khoe gioi-tre giao-duc du-lich van-hoa giai-tri the-thao cong-nghe xe",
    "https://kenh14.vn/": "rss/home star hoc-duong beauty-fashion cine musik the-gioi-do-day doi-song tek-life xem-mua-luon money14 sport xa-hoi an-choi-di suc-khoe the-30s",
    "https://soha.vn/rss/": "home thoi-su-xa-hoi kinh-doanh quoc-te the-thao nhip-song-moi giai-tri phap-luat song-khoe xe cong-nghe doi-song the-gioi",
    "https://afamily.vn/": "trang-chu lifestyle xa-hoi dep me-va-be giao-duc suc-khoe tieu-dung an-ngon tam-su-gia-dinh",
}
# Sitemaps.
SITEMAPS = {
    "tuoitre": "https://tuoitre.vn/sitemaps/index.rss",
    "nhandan": "https://nhandan.vn/sitemap.xml",
    "thanhnien": "https://thanhnien.vn/sitemap.xml",
    "kenh14": "https://kenh14.vn/sitemap.xml",
    "soha": "https://soha.vn/sitemap.xml",
    "afamily": "https://afamily.vn/sitemap.xml",
}
# Categories at crawling time, and those of the features, which differ.
CRAWL_CATEGORIES = {"tuoitre": "formal_news", "nhandan": "formal_news", "thanhnien": "formal_news", "kenh14": "entertainment", "soha": "entertainment", "afamily": "entertainment"}
FEATURE_CATEGORIES = {"tuoitre": "mainstream", "nhandan": "mainstream", "thanhnien": "mainstream", "kenh14": "entertainment", "soha": "mainstream", "afamily": "entertainment"}


def feeds(spark: SparkSession) -> DataFrame:
    """(source, feed), one row for each RSS feed."""
    rows = [(base.split("/")[2].removesuffix(".vn"), f"{base}{name}.rss") for base, names in FEEDS.items() for name in names.split()]
    return spark.createDataFrame(rows, "source string, feed string")


def _lookup(x: Column, table: dict[str, str], default: str) -> Column:
    pairs = [F.lit(v) for kv in table.items() for v in kv]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), x), F.lit(default))


def crawl_category(source: Column) -> Column:
    return _lookup(source, CRAWL_CATEGORIES, "unknown")


def feature_category(source: Column) -> Column:
    return _lookup(source, FEATURE_CATEGORIES, "other")
