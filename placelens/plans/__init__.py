"""Join strategies and the composed analyses."""
