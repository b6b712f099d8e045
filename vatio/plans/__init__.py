"""The models, as functions DataFrame -> DataFrame (they never read paths)."""
