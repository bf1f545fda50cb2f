"""Schemas, readers, writers and the persisted run / model stores."""
