"""Which project an object belongs to, from ordered pattern rules."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from .values import blank_to_null

Rules = tuple[tuple[str, str], ...]


def _first_match(subject: Column, rules: Rules, default: Column) -> Column:
    result = default
    for pattern, project in reversed(rules):
        result = F.when(subject.rlike(pattern), F.lit(project)).otherwise(result)
    return result


@dataclass(frozen=True)
class ProjectRules:
    """Ordered ``(regular expression, project)`` pairs; the first that matches decides.

    The pairs are the deployment's configuration and have no built-in entries.
    """

    models: Rules = ()
    paths: Rules = ()
    systems: Rules = ()
    default: str | None = None
    meta_key: str = "project"

    def _default(self) -> Column:
        return F.lit(self.default).cast("string")

    def for_model(self, name: Column, meta: Column | None = None) -> Column:
        """A project named in the model's own metadata wins over the name patterns."""
        by_name = _first_match(name, self.models, self._default())
        if meta is None:
            return by_name
        named = F.try_element_at(meta, F.lit(self.meta_key))
        return F.coalesce(blank_to_null(named), by_name)

    def for_path(self, path: Column) -> Column:
        return _first_match(path, self.paths, self._default())

    def for_system(self, name: Column) -> Column:
        return _first_match(name, self.systems, self._default())
