"""Building blocks over readings and vehicles, each a DataFrame -> DataFrame function."""
