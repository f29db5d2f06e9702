"""Writers whose loads can be repeated without changing the result."""
