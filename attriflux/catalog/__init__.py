"""Registered queries: every operator over whole tables, with its SQL counterpart where SQL can say it."""
