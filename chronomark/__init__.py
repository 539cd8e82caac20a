"""chronomark: media-timeline analytics as Spark DataFrame plans."""
