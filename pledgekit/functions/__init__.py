from pledgekit.functions import columns

__all__ = ["columns"]
