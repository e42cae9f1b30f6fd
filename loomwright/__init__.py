"""loomwright: text curation, retrieval and segmentation operators as PySpark DataFrame plans."""
