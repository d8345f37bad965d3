from refsync.sources.registry import RESOURCES, ResourceSpec, resource
from refsync.sources.tables import CatalogSource, FileSource, JdbcSource, TableSource

__all__ = [
    "RESOURCES",
    "ResourceSpec",
    "resource",
    "CatalogSource",
    "FileSource",
    "JdbcSource",
    "TableSource",
]
