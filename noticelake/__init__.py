"""noticelake: DataFrame operators for notices, documents and events on Spark."""
