"""Read files of remote sources with Spark: list, spread, download and split them."""
