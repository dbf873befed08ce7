class DataQualityError(Exception):
    """A dataset broke one of its declared rules and must not be written."""
