from stagehouse.sources.staging import StagedDataset, StagingArea

__all__ = ["StagedDataset", "StagingArea"]
