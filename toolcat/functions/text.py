"""Column functions over strings, URLs and formats. Where they are given nothing usable they give null or empty."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, use) -> Column:
    """``use(value)`` with ``value`` computed once."""
    return F.transform(F.array(value), use)[0]


def or_default(value: Column, default) -> Column:
    """A missing key, or an explicit null, gives the default."""
    return F.coalesce(value, default if isinstance(default, Column) else F.lit(default))


def first_text(*values: Column) -> Column:
    """The first value that is neither null nor empty."""
    return F.coalesce(*(F.nullif(v, F.lit("")) for v in values))


def strip(value: Column) -> Column:
    """Without white space, of any script, at the ends."""
    return F.regexp_replace(F.regexp_replace(value, r"(?U)^\s+", ""), r"(?U)\s+$", "")


def git_url_to_api(url: Column, api: str = "https://api.github.com") -> Column:
    """The contents address of a code-host URL; null unless the host is github.com and the path names a
    repository, or a tree with its branch."""
    parts = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)([^?#]*)", 1)
    path = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1)
    split = F.split(F.regexp_replace(F.regexp_replace(path, "^/+", ""), "/+$", ""), "/")

    def build(p: Column) -> Column:
        n = F.size(p)
        base = F.concat(F.lit(f"{api}/repos/"), p[0], F.lit("/"), F.regexp_replace(F.get(p, 1), r"\.git$", ""), F.lit("/contents"))
        branch = F.get(p, 3)
        rest = F.array_join(F.slice(p, 5, F.greatest(n - 4, F.lit(0))), "/")
        query = F.when(branch.isin("master", "main"), F.lit("")).otherwise(F.concat(F.lit("?ref="), branch))
        deep = F.concat(base, F.when(rest != "", F.concat(F.lit("/"), rest)).otherwise(F.lit("")), query)
        return F.when(n == 2, base).when((n >= 4) & F.get(p, 2).isin("tree", "blobl"), deep)

    return F.when(parts == "github.com", let(split, build))


def shed_uri_parts(uri: Column) -> Column:
    """Host, owner, repo, name and revision of a repository tool's id; null if it is none."""

    def build(p: Column) -> Column:
        return F.struct(
            p[0].alias("host"), F.get(p, 2).alias("owner"), F.get(p, 3).alias("repo"), F.get(p, 4).alias("name"),
            F.element_at(p, -1).alias("revision"),
        )

    return F.when(is_shed_uri(uri) & (F.size(F.split(uri, "/")) >= 5), let(F.split(uri, "/"), build))


def is_shed_uri(tool_id: Column) -> Column:
    """whether an id names a repository tool."""
    return F.coalesce(tool_id.startswith("toolshed."), F.lit(False))


def tool_uri(name: Column, owner: Column, repo: Column, version: Column, host: str = "toolshed.g2.bx.psu.edu") -> Column:
    """An id without the ``repos`` part."""
    return F.concat_ws("/", F.lit(host), owner, repo, name, version)


def strip_http(url: Column) -> Column:
    """C4: without one http and then one https prefix."""
    return F.regexp_replace(F.regexp_replace(url, "^http://", ""), "^https://", "")


def strip_query(url: Column) -> Column:
    """Scheme, host and path."""
    return F.regexp_extract(url, r"^([^?#]*)", 1)


def base_path(api_url: Column) -> Column:
    """What follows ``/contents``, without slashes at the ends; empty for a whole repository."""
    path = F.regexp_extract(strip_query(api_url), r"/contents(?:/(.*))?$", 1)
    return F.regexp_replace(F.regexp_replace(path, "/+$", ""), "^/+", "")


def folder_url(api_url: Column, folder: Column, branch: Column) -> Column:
    """The contents address of a folder of the same repository on its default branch."""
    root = F.regexp_extract(strip_query(api_url), r"^(.*?/contents)", 1)
    path = F.regexp_replace(F.concat(root, F.lit("/"), folder), r"(?<!:)/+", "/")
    return F.concat(F.regexp_replace(path, "/$", ""), F.lit("?ref="), branch)


def split_formats(formats: Column) -> Column:
    """The stripped pieces between commas; empty pieces stay, null and '' give none."""
    empty = F.array().cast("array<string>")
    return F.when(F.coalesce(formats, F.lit("")) == "", empty).otherwise(F.transform(F.split(formats, ","), strip))


def clean_categories(values: Column) -> Column:
    """Stripped and lower-cased, without blanks."""
    kept = F.filter(values, lambda x: F.coalesce(strip(x), F.lit("")) != "")
    return F.coalesce(F.transform(kept, lambda x: F.lower(strip(x))), F.array().cast("array<string>"))


def step_tool_id(tool_id: Column, content_id: Column) -> Column:
    """C10 on the input side: the tool id, else the content id."""
    return first_text(tool_id, content_id)


def output_tool_id(tool_id: Column, content_id: Column) -> Column:
    """C10 on the output side: the content id, else the tool id."""
    return first_text(content_id, tool_id)


def source_location(owner: Column, repo: Column, branch: Column, path: Column) -> Column:
    """C11: where a file of a repository can be seen."""
    return F.concat(F.lit("https://github.com/"), F.concat_ws("/", strip(owner), strip(repo), F.lit("blob"), strip(branch), strip(path)))


def without_newlines(uri: Column) -> Column:
    """C12."""
    return F.replace(uri, F.lit("\n"), F.lit(""))


def name_variants(name: Column) -> Column:
    """The spellings under which a name may be stored, without repeats."""
    return F.array_distinct(F.array(
        name, F.translate(name, "-", "_"), F.translate(name, "_", "-"), F.translate(name, "_", ""),
        F.translate(name, "-", ""), F.substring_index(name, "_", 1), F.substring_index(name, "-", 1),
    ))


def tool_id(uri: Column) -> Column:
    """C14: an id of nine letters and digits that depends on the uri alone."""
    digest = F.lower(F.conv(F.substring(F.sha2(uri, 256), 1, 15), 16, 36))
    return F.concat(F.lit("edc:tool:"), F.substring(F.lpad(digest, 12, "0"), -9, 9))


def resolve_path(folder: Column, relative: Column) -> Column:
    """A relative path seen from a folder, with ``.`` and ``..`` worked off."""
    parts = F.filter(F.split(F.concat_ws("/", folder, relative), "/"), lambda p: ~p.isin("", "."))
    empty = F.array().cast("array<string>")
    kept = F.aggregate(
        parts, empty,
        lambda done, p: F.when(p == "..", F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0)))).otherwise(F.concat(done, F.array(p))),
    )
    return F.array_join(kept, "/")


def parent_dir(path: Column) -> Column:
    return F.regexp_extract(path, r"^(.*)/[^/]*$", 1)


def file_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def under_base(base: Column, path: Column) -> Column:
    """equal in every part over the shorter of the two; an empty base holds everything."""
    a, b = F.split(F.regexp_replace(base, "^/+|/+$", ""), "/"), F.split(F.regexp_replace(path, "^/+|/+$", ""), "/")
    n = F.least(F.size(a), F.size(b))
    return F.coalesce(base.isin("", "/"), F.lit(True)) | (F.slice(a, 1, n) == F.slice(b, 1, n))


def sorted_set(values: Column) -> Column:
    return F.array_sort(F.array_distinct(values))
