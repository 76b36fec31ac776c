"""kinfold: entity resolution and corpus statistics as Spark plans."""
