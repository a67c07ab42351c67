"""Cleaning and key functions, Column to Column."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# Patterns of pages that are no articles.
REJECTED_URLS = (
    r"/video/", r"/tag/", r"/tags/", r"/author/", r"/amp$", r"/amp/", r"\?page=\d+", r"/page/\d+", r"#comment", r"/search\?", r"/tim-kiem/", r"/rss", r"/sitemap",
    r"\.rss$", r"\.xml$", r"/category/?$", r"/chuyen-muc/?$", r"/the-loai/?$", r"/photo/", r"/media/", r"/podcast/", r"/interactive/", r"/timeline/", r"/su-kien/",
    r"/chu-de/", r"/infographic/", r"/live/", r"/truc-tiep/", r"/tin-moi-nhat/?$",
)
# Boilerplate that runs to the end of its line, everywhere and by source.
BOILERPLATE = (r"vui lòng đăng ký nhận bản tin.*", r"theo dõi chúng tôi trên.*", r"bản quyền thuộc về.*")
SOURCE_BOILERPLATE = {
    "nhandan": (
        r"Chúng tôi xin thông báo để các cơ quan, đoàn thể, đơn vị, trường học và bạn đọc đặt mua các ấn phẩm Báo Nhân Dân.*",
        r"Đường dây nóng: \(84\) 24 393 82413.*",
        r"Xin trân trọng cảm ơn!",
        r"Truy cập nhandan.vn để xem thêm chi tiết.*",
    ),
    "kenh14": (r"Xem thêm các bài viết cùng chủ đề.*",),
}
# Phrases of links to more text, and image endings.
READ_MORE = r"xem thêm|đọc thêm|click để xem chi tiết|tiếp tục đọc"
IMAGES = r"https?://\S+\.(?:jpg|jpeg|png|gif|webp|avif)\S*"
# Terms of sensational titles, in the order in which they are tried.
SENSATIONAL = ("sốc", "ngã ngửa", "nóng", "cực hot", "không thể tin nổi", "bí mật", "hé lộ", "sự thật", "xôn xao", "chấn động", "lộ diện", "bất ngờ", "đằng sau", "chi tiết", "cận cảnh", "ngỡ ngàng", "kinh hoàng")

#: Unicode white space, alike in every regular expression dialect.
SPACE = r"[\x09-\x0D\x1C-\x20\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"


def strip(x: Column) -> Column:
    return F.regexp_replace(x, f"^{SPACE}+|{SPACE}+$", "")


def squeeze(x: Column) -> Column:
    return F.regexp_replace(x, f"{SPACE}+", " ")


def tokens(x: Column) -> Column:
    """Words between white space; none for an empty text."""
    return F.filter(F.split(x, f"{SPACE}+"), lambda w: w != "")


def crawl_url(url: Column) -> Column:
    """Key of a crawled address: trimmed, without trailing slashes; null gives ''."""
    return F.regexp_replace(strip(F.coalesce(url, F.lit(""))), "/+$", "")


def article_id(source: Column, url: Column) -> Column:
    return F.concat_ws("_", source, F.left(F.md5(crawl_url(url).cast("binary")), F.lit(12)))


def canonical_url(url: Column) -> Column:
    """Scheme and host in lower case, no fragment."""
    plain = F.regexp_replace(strip(url), "#.*$", "")
    head = F.regexp_extract(plain, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?]*", 0)
    return F.concat(F.lower(head), F.substr(plain, F.length(head) + 1, F.length(plain)))


def keep_url(url: Column) -> Column:
    """False for null, empty and non-article addresses."""
    return F.coalesce((url != "") & ~canonical_url(url).rlike("(?i)(?:" + "|".join(REJECTED_URLS) + ")"), F.lit(False))


@F.pandas_udf(StringType())
def _unescape_compose(texts: pd.Series) -> pd.Series:
    import html
    import unicodedata

    return texts.map(lambda t: html.unescape(unicodedata.normalize("NFC", t)), na_action="ignore")


@F.pandas_udf(StringType())
def _unescape_ended_compose(texts: pd.Series) -> pd.Series:
    import html
    import html.entities
    import re
    import unicodedata

    def decoded(m: re.Match) -> str:
        return html.unescape(m[0]) if m[1][0] == "#" else html.entities.html5.get(f"{m[1]};", m[0])

    ended = re.compile(r"&(#[0-9]+|#[xX][0-9a-fA-F]+|[A-Za-z][A-Za-z0-9]*);")
    return texts.map(lambda t: ended.sub(decoded, unicodedata.normalize("NFC", t)), na_action="ignore")


def rescue_utf8(x: Column) -> Column:
    """UTF-8 that was read as Latin-1, read anew; other text as it is."""
    latin = x.rlike(r"^[\x00-\xFF]*$") & x.rlike(r"[\x80-\xFF]")
    raw = F.encode(F.when(latin, x), "ISO-8859-1")
    return F.coalesce(F.try_validate_utf8(raw.cast("string")), x)


def clean(x: Column, open_entities: bool = True) -> Column:
    """Rescue, NFC, entities, plain quotes and dashes, single spaces, no zero-width characters.

    Only texts that have other than ASCII characters or an ampersand go through Python.  Without
    ``open_entities`` an entity needs its semicolon: a text cut at ``&amp`` keeps that.
    """
    x = rescue_utf8(x)
    unescape_compose = _unescape_compose if open_entities else _unescape_ended_compose
    x = F.coalesce(unescape_compose(F.when(x.rlike(r"[^\x00-\x7F]|&"), x)), x)
    x = F.replace(F.translate(x, "“”‘’–—�", "\"\"''--"), F.lit("…"), F.lit("..."))
    return F.regexp_replace(squeeze(strip(x)), r"[\x{200B}-\x{200D}\x{FEFF}]", "")


def truncate(x: Column, most: int = 500, suffix: str = "...") -> Column:
    return F.when(F.length(x) > most, F.concat(F.left(x, F.lit(most)), F.lit(suffix))).otherwise(x)


def without_tags(x: Column) -> Column:
    return F.regexp_replace(x, "<[^>]+>", "")


def html_title(html: Column, open_entities: bool = True) -> Column:
    """h1, else og:title, else title without the site's name; each of over five characters."""

    def clean_part(x: Column) -> Column:
        return clean(x, open_entities)

    def if_long(x: Column) -> Column:
        return F.when(F.length(x) > 5, x)

    h1 = clean_part(without_tags(F.regexp_extract(html, r"(?is)<h1[^>]*>(.*?)</h1>", 1)))
    og = clean_part(F.regexp_extract(html, r"""(?i)<meta\s+property=["']og:title["']\s+content=["']([^"']+)["']""", 1))
    title = strip(F.regexp_replace(clean_part(F.regexp_extract(html, r"(?is)<title>(.*?)</title>", 1)), r"\s*[-|&]\s*[^-]+$", ""))
    return F.coalesce(if_long(h1), if_long(og), if_long(title))


def paragraphs(html: Column) -> Column:
    inner = F.regexp_extract_all(html, F.lit(r"(?is)<p(?:\s[^>]*)?>(.*?)</p>"), 1)
    return F.transform(inner, lambda p: strip(without_tags(p)))


def paragraph_body(html: Column) -> Column:
    """Paragraphs of over 20 characters, joined; null unless over 200 in all."""
    body = F.array_join(F.filter(paragraphs(html), lambda p: F.length(p) > 20), " ")
    return F.when(F.length(body) > 200, body)


def paragraph_lead(html: Column) -> Column:
    """The first paragraph of over 40 characters."""
    return F.get(F.filter(paragraphs(html), lambda p: F.length(p) > 40), 0)


def clean_lead(x: Column, handles: bool = True, open_entities: bool = True) -> Column:
    """A lead without tags, image links, read-more phrases and, with ``handles``, handles; '' counts as missing.

    A handle is all that follows an ``@``, so with ``handles`` mail addresses lose the first part of their domain.
    """
    x = squeeze(strip(F.regexp_replace(F.nullif(x, F.lit("")), "<[^>]+>", " ")))
    x = F.regexp_replace(x, f"(?i){IMAGES}", "")
    x = F.regexp_replace(x, f"(?iu)(?:{READ_MORE})", "")
    return clean(F.regexp_replace(x, r"@[\p{L}\p{N}_]+", "") if handles else x, open_entities)


def remove_boilerplate(x: Column, source: Column, open_entities: bool = True) -> Column:
    out = F.nullif(x, F.lit(""))
    for p in BOILERPLATE:
        out = F.regexp_replace(out, f"(?iu){p}", "")
    for name, patterns in SOURCE_BOILERPLATE.items():
        own = out
        for p in patterns:
            own = F.regexp_replace(own, f"(?iu){p}", "")
        out = F.when(source == name, own).otherwise(out)
    return clean(out, open_entities)


def dedup_key(x: Column) -> Column:
    """Lower case, only letters, digits and underscores, single spaces; null gives ''."""
    words = F.regexp_replace(F.lower(F.coalesce(x, F.lit(""))), r"[^\p{L}\p{N}_]", " ")
    return strip(F.regexp_replace(words, " +", " "))


def feed_type(url: Column) -> Column:
    """Stem of the address's last part without trailing digits."""
    return F.regexp_replace(F.regexp_extract(url, r"([^/]*?)(?:\.[^./]*)?$", 1), r"-\d+$", "")


def combined(title: Column, lead: Column) -> Column:
    return F.btrim(F.concat(F.coalesce(title, F.lit("")), F.lit(" "), F.coalesce(lead, F.lit(""))))


def texts_hash(id_col: str, text_col: str) -> Column:
    """Aggregate: md5 of the number of rows and the first and last text by id."""
    ends = [F.coalesce(f(text_col, id_col), F.lit("")) for f in (F.min_by, F.max_by)]
    return F.md5(F.concat(F.count(F.lit(1)).cast("string"), *ends).cast("binary"))


def timestamp_of(x: Column) -> Column:
    """ISO time, date, or epoch milliseconds; anything else is null."""
    millis = F.timestamp_millis(x.try_cast("bigint"))
    return F.coalesce(millis, F.try_to_timestamp(x))


def prompt(template: str, title: Column, lead: Column) -> Column:
    def quoted(x: Column) -> Column:
        return F.replace(F.coalesce(x, F.lit("")), F.lit('"'), F.lit("'"))

    return F.replace(F.replace(F.lit(template), F.lit("{title}"), quoted(title)), F.lit("{sapo}"), quoted(lead))
