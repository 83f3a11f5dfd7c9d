"""Column functions; all are built-in Spark expressions."""

from guardwork.functions.events import event_document, grantee_name
from guardwork.functions.text import ci, config_name, same_name

__all__ = ["ci", "config_name", "event_document", "grantee_name", "same_name"]
