"""Where a catalog lives and which prefixes its context defines."""

from __future__ import annotations

from dataclasses import dataclass, field

SCHEMA_ORG = "http://schema.org/"
XSD = "http://www.w3.org/2001/XMLSchema#"
RDF_TYPE = "http://www.w3.org/1999/02/22-rdf-syntax-ns#type"

# The CURIE prefix of catalog documents and public prefix IRIs.
CATALOG_PREFIX = "ldr"
PREFIXES = {
    "schema": SCHEMA_ORG,
    "xsd": XSD,
    "rdf": "http://www.w3.org/1999/02/22-rdf-syntax-ns#",
    "rdfs": "http://www.w3.org/2000/01/rdf-schema#",
    "foaf": "http://xmlns.com/foaf/0.1/",
    "dc": "http://purl.org/dc/terms/",
    "github": "https://github.com/",
    "bitbucket": "https://bitbucket.org/",
}

# Properties whose string values are IRIs rather than literals.
IRI_PROPERTIES = ("contentUrl", "downloadUrl", "codeRepository", "isBasedOnUrl", "license", "url", "sameAs")


@dataclass(frozen=True)
class Catalog:
    """Address and context of one catalog."""

    protocol: str = "https:"
    hostname: str = "catalog.example"
    port: int | None = None
    hosts: tuple[str, ...] = ()
    prefixes: dict[str, str] = field(default_factory=lambda: dict(PREFIXES))
    iri_properties: tuple[str, ...] = IRI_PROPERTIES
    vocab: str = SCHEMA_ORG

    @property
    def base(self) -> str:
        """Base IRI, with the default HTTP ports left out."""
        port = f":{self.port}" if self.port and self.port not in (80, 443) else ""
        return f"{self.protocol}//{self.hostname}{port}/"

    @property
    def context(self) -> str:
        """The ``@context`` value that names this catalog's own context."""
        return self.base.rstrip("/")

    @property
    def catalog_hosts(self) -> tuple[str, ...]:
        """Hosts whose URLs belong to the catalog."""
        return tuple(dict.fromkeys((self.hostname, *self.hosts)))

    @property
    def context_prefixes(self) -> dict[str, str]:
        """All prefixes, the catalog's own included."""
        return {CATALOG_PREFIX: self.base, **self.prefixes}


DEFAULT = Catalog()
