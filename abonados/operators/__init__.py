"""DataFrame operators shared by the layers."""
