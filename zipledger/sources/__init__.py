from .adapters import (attempts_from_manifest, completions_from_events, content_from_documents,
                       inventory_from_events, load_table, manifest_from_orders)
from .manifest import read_manifest

__all__ = ["attempts_from_manifest", "completions_from_events", "content_from_documents",
           "inventory_from_events", "load_table", "manifest_from_orders", "read_manifest"]
