"""tagweave: a catalog-driven user-profile (tag) engine on PySpark.

A catalog of tags, tasks and label rules drives four batch jobs:

* tag job    - run a tag's SQL for a date, label values, store a typed
               ``(uid, query_value)`` slice partitioned by ``dt``;
* merge job  - union the enabled tags of a date and pivot them into one
               wide row per uid;
* export job - write the wide table clustered by uid (files or JDBC);
* bitmap job - unpivot the wide table and build a uid bitmap per
               (tag, value) in one typed table per value type.

All data work is DataFrame / SQL, planned by Catalyst.
"""

from tagweave.codes import (  # noqa: F401
    TYPE_DATE,
    TYPE_DECIMAL,
    TYPE_LONG,
    TYPE_STRING,
)
from tagweave.session import get_session, shared_root  # noqa: F401
from tagweave.sources.catalog import Catalog  # noqa: F401
from tagweave.sources.store import ProfileStore  # noqa: F401

__all__ = [
    "Catalog",
    "ProfileStore",
    "get_session",
    "shared_root",
    "TYPE_LONG",
    "TYPE_DECIMAL",
    "TYPE_STRING",
    "TYPE_DATE",
]
