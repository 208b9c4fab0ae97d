"""Writers whose reruns replace exactly what they wrote before."""
