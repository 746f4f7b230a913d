"""URLs, CURIEs, repository addresses and the ids derived from them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from linkcat.config import CATALOG_PREFIX, DEFAULT, Catalog
from linkcat.functions.mime import basename, literal_map

SCHEME = r"(?:[A-Za-z][A-Za-z0-9+.-]*:)?"
USER = r"(?:[^\s/?#@]+@)?"
# A host is this machine, or names joined by dots of which the last has two characters or more.
HOST = r"(?:localhost|(?:[^\s/?#:.]+\.)+[^\s/?#:.]{2,}\.?)"
AFTER_HOST = r"(?::\d*)?(?:[/?#]\S*)?"
IS_URL = "^" + SCHEME + "//" + USER + HOST + AFTER_HOST + "$"
URL_HOST = r"^(?:[A-Za-z][\w+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)"
URL_PATH = r"^(?:[A-Za-z][\w+.-]*:)?//[^/?#]*([^?#]*)"
URL_SEGMENT = r"^(?:[A-Za-z][\w+.-]*:)?//[^/?#]*/?([^/?#]*)"
CURIE_SEGMENT = r"^(?:[^:/]*:)?/?([^/?#]*)"
REPO = r"^(?:(?:https?|git|ssh)://(?:www\.|git@)?|git@)?({host})[:/]([\w.-]+)/([\w.-]+?)(?:\.git)?(?:/tree/([\w./-]+?))?/?$"
GITHUB = REPO.format(host=r"github(?:\.com)?")
BITBUCKET = REPO.format(host=r"bitbucket(?:\.org)?")


def split_typed_spec(spec: Column) -> Column:
    """``resource::Type`` as a struct ``(id, type)``; the type may be missing."""
    parts = F.split(spec, "::")
    return F.struct(
        F.get(parts, 0).alias("id"),
        F.nullif(F.get(parts, 1), F.lit("")).alias("type"),
    )


def repo_address(spec: Column) -> Column:
    """Struct ``(repo, https_url, tarball_url)`` of a GitHub or Bitbucket address, else NULL.

    Accepts web, git and ssh addresses and the ``github:`` / ``bitbucket:`` CURIEs.
    """

    def part(pattern: str, group: int) -> Column:
        return F.regexp_extract(spec, pattern, group)

    def address(pattern: str, site: str, tarball) -> Column:
        owner, repo = part(pattern, 2), part(pattern, 3)
        branch = F.coalesce(F.nullif(part(pattern, 4), F.lit("")), F.lit("master"))
        return F.struct(
            repo.alias("repo"),
            F.concat(F.lit(site), owner, F.lit("/"), repo).alias("https_url"),
            tarball(owner, repo, branch).alias("tarball_url"),
        )

    github = address(
        GITHUB, "https://github.com/",
        lambda o, r, b: F.concat(F.lit("https://api.github.com/repos/"), o, F.lit("/"), r, F.lit("/tarball/"), b),
    )
    bitbucket = address(
        BITBUCKET, "https://bitbucket.org/",
        lambda o, r, b: F.concat(
            F.lit("https://bitbucket.org/"), o, F.lit("/"), r, F.lit("/get/"), b, F.lit(".tar.gz")),
    )
    return F.when(spec.rlike(GITHUB), github).when(spec.rlike(BITBUCKET), bitbucket)


def is_url(spec: Column) -> Column:
    """Whether an input names a web resource (repository addresses included)."""
    return spec.rlike(IS_URL) | spec.rlike(GITHUB) | spec.rlike(BITBUCKET)


def url_host(url: Column) -> Column:
    """Host of an absolute URL; NULL when there is none."""
    return F.nullif(F.regexp_extract(url, URL_HOST, 1), F.lit(""))


def url_path(url: Column) -> Column:
    """Path of an absolute URL, ``/`` when empty."""
    return F.regexp_replace(F.regexp_extract(url, URL_PATH, 1), "^$", "/")


def strip_slashes(path: Column) -> Column:
    """Drop one leading and one trailing slash."""
    return F.regexp_replace(path, r"^/|/$", "")


def resolve_curie(ref: Column, catalog: Catalog = DEFAULT, keep_prefix_path: bool = False) -> Column:
    """Struct ``(url, error)``: URLs pass through, CURIEs and pathnames are resolved.

    A foreign prefix contributes its scheme and host only, unless ``keep_prefix_path``.
    """
    prefix, local = F.split_part(ref, F.lit(":"), F.lit(1)), F.split_part(ref, F.lit(":"), F.lit(2))
    is_curie = F.size(F.split(ref, ":")) == 2
    origins = {}
    for name, iri in catalog.prefixes.items():
        scheme, _, rest = iri.partition("//")
        origins[name] = iri if keep_prefix_path else f"{scheme}//{rest.split('/')[0]}/"
    origins[CATALOG_PREFIX] = catalog.base
    origin = F.try_element_at(literal_map(origins), prefix)
    absolute = ref.rlike(IS_URL)
    url = (
        F.when(absolute, ref)
        .when(is_curie, F.concat(origin, strip_slashes(local)))
        .otherwise(F.concat(F.lit(catalog.base), strip_slashes(ref)))
    )
    error = F.when(
        ~absolute & is_curie & origin.isNull(),
        F.concat(F.lit("unsupported CURIE prefix: "), prefix),
    )
    return F.struct(url.alias("url"), error.alias("error"))


def namespace_of(
    ref: Column, catalog: Catalog = DEFAULT, is_catalog_host: Callable[[Column], Column] | None = None
) -> Column:
    """First path segment of a catalog URL or CURIE; NULL for foreign hosts."""
    absolute = ref.rlike(IS_URL)
    hosts = {name: iri.partition("//")[2].split("/")[0].split(":")[0] for name, iri in catalog.context_prefixes.items()}
    prefix_host = F.try_element_at(literal_map(hosts), F.split_part(ref, F.lit(":"), F.lit(1)))
    host = (
        F.when(absolute, url_host(ref)).when(ref.contains(":"), prefix_host).otherwise(F.lit(catalog.hostname)))
    ours = is_catalog_host(host) if is_catalog_host else host.isin(*catalog.catalog_hosts)
    segment = F.when(absolute, F.regexp_extract(ref, URL_SEGMENT, 1)).otherwise(
        F.regexp_extract(ref, CURIE_SEGMENT, 1))
    return F.when(ours, segment)


def doc_root(ref: Column, catalog: Catalog = DEFAULT, base: str = "") -> Column:
    """Folder that holds a clone of the document: host and path below ``base``."""
    url = resolve_curie(ref, catalog)["url"]
    below = F.concat_ws("/", url_host(url), F.nullif(strip_slashes(url_path(url)), F.lit("")))
    return F.concat(F.lit(f"{base.rstrip('/')}/"), below) if base else below


def slug(path: Column, tarballs: bool = True) -> Column:
    """Id from a file name: extension off, spaces to dashes, lower case, ``p`` when empty."""
    ending = r"(?<=.)(\.tar\.gz|\.[^.]*)$" if tarballs else r"(?<=.)\.[^.]*$"
    stem = F.regexp_replace(F.regexp_replace(basename(path), ending, ""), r"^\s+|\s+$", "")
    return F.regexp_replace(F.lower(F.replace(stem, F.lit(" "), F.lit("-"))), "^$", "p")


def below_namespace(name: Column, namespace: Column) -> Column:
    """Name below a namespace; without one the name itself."""
    return F.concat(F.regexp_replace(F.concat(F.coalesce(namespace, F.lit("")), F.lit("/")), "^/$", ""), name)


def slug_id(path: Column, namespace: Column | None = None) -> Column:
    """Slug below a namespace; the prefix is added after the empty-name fallback."""
    name = slug(path)
    return name if namespace is None else below_namespace(name, namespace)


def url_slug_id(url: Column, namespace: Column | None = None) -> Column:
    """Slug of a URL's path; only the last extension is removed."""
    name = slug(F.regexp_extract(url, URL_PATH, 1), tarballs=False)
    return name if namespace is None else below_namespace(name, namespace)


def relative_path(path: Column, root: str) -> Column:
    """Path below ``root``, without a trailing slash."""
    prefix = root.rstrip("/") + "/"
    below = F.when(path.startswith(prefix), F.substring(path, F.lit(len(prefix) + 1), F.length(path))).otherwise(path)
    return F.regexp_replace(below, "/+$", "")


def parent_dirs(path: Column) -> Column:
    """Every proper ancestor directory of a path, each with its trailing slash."""
    parts = F.split(F.regexp_replace(path, "/+$", ""), "/")
    depth = F.size(parts) - 1
    steps = F.when(depth > 0, F.sequence(F.lit(1), depth)).otherwise(F.array().cast("array<int>"))
    return F.transform(steps, lambda n: F.concat(F.array_join(F.slice(parts, F.lit(1), n), "/"), F.lit("/")))
