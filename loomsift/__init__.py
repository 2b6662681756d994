"""loomsift: a text-dataset curation engine expressed as Spark DataFrame plans."""
