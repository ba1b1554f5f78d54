"""Parsed corpora as catalog bundles, ready for ``commit_bundle``."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..functions.projects import ProjectRules
from ..session import checkpointed
from . import collections, interfaces, manifests, specs


def api_bundle(
    spec_corpus: DataFrame, collection_corpus: DataFrame, rules: ProjectRules = ProjectRules()
) -> dict[str, DataFrame]:
    """Relations of specifications and collections. Files later in the walk win."""
    requests = checkpointed(collections.flow_requests(collection_corpus))
    steps = collections.request_steps(requests)
    return {
        "api_sources": specs.spec_sources(spec_corpus, rules),
        "api_endpoints": specs.spec_endpoints(spec_corpus, rules),
        "api_fields": specs.spec_fields(spec_corpus, rules),
        "api_endpoint_errors": specs.spec_errors(spec_corpus, rules),
        "api_flows": collections.flows(collection_corpus, requests, rules),
        "api_flow_steps": collections.flow_steps(steps),
        "api_dependencies": collections.flow_dependencies(steps),
    }


def manifest_bundle(
    manifest_corpus: DataFrame, catalog_corpus: DataFrame, rules: ProjectRules = ProjectRules()
) -> dict[str, DataFrame]:
    return {
        "datasets": manifests.datasets(manifest_corpus, rules),
        "columns": manifests.columns(manifest_corpus, catalog_corpus),
        "transformations": manifests.transformations(manifest_corpus, rules),
        "transform_lineage": manifests.lineage(manifest_corpus, rules),
    }


def interface_bundle(
    interface_list: DataFrame, rules: ProjectRules = ProjectRules()
) -> dict[str, DataFrame]:
    return {
        "interface360_interfaces": interfaces.interface_rows(interface_list),
        "interface360_routing_hops": interfaces.routing_hops(interface_list, rules),
        "interface360_systems": interfaces.system_traffic(interface_list, rules),
    }
