"""Column functions on host names, reversed names and URLs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def reverse_host(name: Column) -> Column:
    """com.example.www <-> www.example.com; trailing dots go, inner and leading empty labels stay."""
    return F.array_join(F.reverse(F.split(F.regexp_replace(name, r"\.+$", ""), r"\.")), ".")


def strip_www(host: Column) -> Column:
    """Without a leading ``www.``, unless nothing but a single label would remain (www.com)."""
    rest = F.substring(host, 5, 1 << 30)
    return F.when(host.startswith("www.") & (F.instr(rest, ".") > 0), rest).otherwise(host)


def top_level_domain(rev_name: Column) -> Column:
    """First label of a reversed name; the whole name if it has no dot."""
    return F.substring_index(rev_name, ".", 1)


def first_labels(rev_name: Column, n) -> Column:
    """The first n labels of a reversed name; n may be a column."""
    return F.array_join(F.slice(F.split(rev_name, r"\."), F.lit(1), n if isinstance(n, Column) else F.lit(n)), ".")


def url_host(url: Column) -> Column:
    """Lower-case host of a URL, null if there is none."""
    return F.lower(F.call_function("try_parse_url", url, F.lit("HOST")))


def link_host(link: Column, page_host: Column) -> Column:
    """Host a link leads to: its own if it is absolute or protocol-relative, else that of the page."""
    absolute = F.when(link.startswith("//"), F.concat(F.lit("http:"), link)).otherwise(link)
    return F.when(F.lower(link).rlike("^(https?:)?//"), url_host(absolute)).when(link.rlike("^[A-Za-z][A-Za-z0-9+.-]*:"), F.lit(None)).otherwise(page_host)


_LABEL = "[a-z0-9_]([a-z0-9_-]{0,61}[a-z0-9_])?"


def is_valid_host(host: Column) -> Column:
    """At least two labels of letters, digits, hyphens and underscores, at most 253 characters, an alphabetic (or xn--) last label."""
    return F.coalesce((F.length(host) <= 253) & host.rlike(rf"^({_LABEL}\.)+([a-z]{{2,63}}|xn--[a-z0-9-]{{1,59}})$"), F.lit(False))


def normalize_host(host: Column) -> Column:
    """Lower case, no surrounding white space or dots."""
    return F.lower(F.regexp_replace(F.trim(host), r"^\.+|\.+$", ""))


#: Letters, digits, dots, hyphens and underscores, no leading mark.
GRAPH_NAME = "[A-Za-z0-9][A-Za-z0-9._-]*"


def is_graph_name(name: Column) -> Column:
    """Whether a graph may be called so."""
    return F.coalesce(name.rlike(f"^{GRAPH_NAME}\\z"), F.lit(False))


def _to_ascii(hosts):
    """``xn--`` forms of a pandas series; null where there is none."""

    def one(host):
        try:
            return host.encode("idna").decode().lower()
        except UnicodeError:
            return None

    return hosts.map(one)


def ascii_hosts(df: DataFrame, col: str) -> DataFrame:
    """df with the host names of a column in ASCII; null where a name has no such form.  Only names beyond ASCII are
    mapped, each once: the others never leave the JVM."""
    other = F.col(col).rlike(r"[^\x00-\x7F]")
    to_ascii = F.pandas_udf(_to_ascii, "string")
    known = df.where(other).select(F.col(col).alias("__lf_host")).distinct().withColumn("__lf_ascii", to_ascii("__lf_host"))
    out = df.join(known, F.col(col) == F.col("__lf_host"), "left")
    return out.withColumn(col, F.when(other, F.col("__lf_ascii")).otherwise(F.col(col))).drop("__lf_host", "__lf_ascii")


def vertex_text(id_: Column, label: Column) -> Column:
    return F.format_string("#%d\t%s", id_, label)
