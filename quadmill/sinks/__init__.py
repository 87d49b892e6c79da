"""Writers: tiles, meshes, text, archives."""
