"""The operators bound to the driver tables, each with its SQL counterpart where SQL can say it."""
