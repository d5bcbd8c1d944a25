"""Object addresses, file names and the folders made from them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# The web hosts that address the same objects as gs://.
WEB_HOSTS = ("storage.googleapis.com", "storage.cloud.google.com")
# Sub-folder of each output category.
CATEGORY_SUBDIRS = {"normal": "", "declined": "Declined/", "rejected": "Rejected/"}
# Month labels used in batch folder names, January first.
MONTH_LABELS = ("Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec")


def natural_key(name: Column) -> Column:
    """Sort key under which ``a2`` comes before ``a10``.

    Each element pairs a run of text with the number after it. A number is held
    as (digit count, digits) without leading zeros, so any length compares right.
    """
    chunks = F.regexp_extract_all(F.lower(name), F.lit("[^0-9]*[0-9]+|[^0-9]+"), F.lit(0))

    def element(chunk: Column) -> Column:
        digits = F.regexp_extract(chunk, "([0-9]+)$", 1)
        bare = F.regexp_replace(digits, "^0+", "")
        return F.struct(
            F.regexp_extract(chunk, "^([^0-9]*)", 1).alias("text"),
            F.when(digits != "", F.length(bare)).alias("digit_count"),
            F.when(digits != "", bare).alias("digits"),
        )

    return F.transform(chunks, element)


def norm_prefix(prefix: Column) -> Column:
    """A prefix that ends in a slash."""
    return F.when(prefix.endswith("/"), prefix).otherwise(F.concat(prefix, F.lit("/")))


def _unquote(text: Column) -> Column:
    """Percent-decoding that keeps a plus sign and leaves bad sequences alone."""
    kept = F.regexp_replace(F.replace(text, F.lit("+"), F.lit("%2B")), "%(?![0-9A-Fa-f]{2})", "%25")
    return F.coalesce(F.try_url_decode(kept), text)


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Names a value used several times, so that it is worked out once."""
    return F.transform(F.array(value), body)[0]


def parse_uri(uri: Column) -> Column:
    """``struct<bucket, object, error>`` of a ``gs://`` or web address."""
    hosts = "|".join(host.replace(".", r"\.") for host in WEB_HOSTS)
    web = F.regexp_extract(uri, rf"^[A-Za-z][A-Za-z0-9+.-]*://(?:{hosts})/+([^?#]*)", 1)
    rest = F.when(uri.startswith("gs://"), F.substring(uri, 6, 1 << 30)).when(
        uri.rlike(rf"^[A-Za-z][A-Za-z0-9+.-]*://(?:{hosts})(?:[/?#]|$)"), web
    )
    pattern = "(?s)^([^/]+)/(.+)$"

    def parts(decoded: Column) -> Column:
        good = F.coalesce(decoded.rlike(pattern), F.lit(False))
        return F.struct(
            F.when(good, F.regexp_extract(decoded, pattern, 1)).alias("bucket"),
            F.when(good, F.regexp_extract(decoded, pattern, 2)).alias("object"),
            F.when(decoded.isNull(), F.lit("not a recognised object address"))
            .when(~good, F.lit("no bucket and object in the address")).alias("error"),
        )

    return _let(_let(rest, _unquote), parts)


def relative_folder(uri: Column, root: Column) -> Column:
    """First folder below the swept root, null when the object lies right in it."""
    prefix = _let(parse_uri(root)["object"], lambda name: F.when(name.endswith("/"), name).otherwise(
        F.concat(F.regexp_extract(name, "^(.*)/[^/]*$", 1), F.lit("/"))))

    def below(pair: Column) -> Column:
        name, start = pair["name"], pair["prefix"]
        rest = F.when(F.startswith(name, start), F.substring(name, F.length(start) + 1, F.length(name))).otherwise(name)
        return _let(rest, lambda r: F.when(F.contains(r, F.lit("/")), F.substring_index(r, "/", 1)))

    return _let(F.struct(parse_uri(uri)["object"].alias("name"), prefix.alias("prefix")), below)


def base_name(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def stem(file_name: Column) -> Column:
    """File name without its last suffix."""
    return F.regexp_replace(file_name, r"\.[^.]*$", "")


def unit_name(stem_: Column, index: Column) -> Column:
    return F.concat(stem_, F.lit("_p"), index.cast("string"), F.lit(".pdf"))


def legacy_unit_name(year: Column, stem_: Column, start_index: Column) -> Column:
    """Older naming: year first, then the 1-based first page of the unit."""
    return F.concat(year.cast("string"), F.lit("_"), unit_name(stem_, start_index + 1))


def batch_folder(month: Column, day: Column, suffix: Column) -> Column:
    labels = F.array(*[F.lit(m) for m in MONTH_LABELS])
    return F.concat(F.try_element_at(labels, month), day.cast("string"), F.lit("_"), suffix)


def category_subdir(category: Column) -> Column:
    pairs = [F.lit(part) for item in CATEGORY_SUBDIRS.items() for part in item]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), category), F.lit(""))


def destination_path(prefix: Column, category: Column, folder: Column, name: Column) -> Column:
    return F.concat(norm_prefix(prefix), category_subdir(category), folder, F.lit("/"), name)
