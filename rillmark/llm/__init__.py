"""Training-data operators for text and entities. Nothing else in the library imports this subpackage."""
