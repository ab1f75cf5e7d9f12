"""regraft: move linked records between two populated datasets with Spark."""

from regraft.operators.relationship import Relationship
from regraft.sources.app import App
from regraft.sources.staging import Staging

__all__ = ["App", "Relationship", "Staging"]
